"""Retention-risk analytics over many cohorts at once, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
