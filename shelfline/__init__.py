"""Retail feeds to gold datasets, written as Spark DataFrame jobs."""
