"""Retail sales engine on Spark: feeds to bronze, silver and gold tables."""
