"""Retail analytics on Spark: cleaning, star schema, marts, query library and quality gates."""
