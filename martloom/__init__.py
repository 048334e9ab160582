"""Retail sales analytics on Spark: layered ingestion, star schema, quality checks and reports."""
