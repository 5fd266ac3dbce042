"""Structured Streaming: ingestion into the store, live statistics, windows."""
