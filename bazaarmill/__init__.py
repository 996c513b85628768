"""Retail warehouse operators, data-quality rules and reports as Spark DataFrame jobs."""
