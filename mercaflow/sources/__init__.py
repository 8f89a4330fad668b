"""Readers of raw feeds and of stored tables."""
