"""Relational operators: cleaning, batching, statistics, reconciliation, quality, gold."""
