"""Readers: file listings, CSV, Parquet and stored tables."""
