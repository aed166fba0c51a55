"""Spark-first analytics for ordered capture data."""
