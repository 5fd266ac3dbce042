"""Whole runs, reports, and the queries over the given tables."""
