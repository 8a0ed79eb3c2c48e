"""Dealership analytics on Spark: ingest of dirty CSV exports, business queries, derived analytics."""
