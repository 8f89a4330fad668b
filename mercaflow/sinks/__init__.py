"""Partitioned parquet writes and catalog registration."""
