"""Retail lakehouse on Spark: bronze, silver and gold layers, views and metrics."""
