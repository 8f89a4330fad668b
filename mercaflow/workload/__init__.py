"""Retail views over the supplied star schema, and the queries run on them."""
