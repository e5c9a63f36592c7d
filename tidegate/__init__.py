"""Incremental ingest and data quality on Spark DataFrames."""
