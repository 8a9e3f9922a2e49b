"""Spark jobs that turn gridded environmental products into a daily training table."""
