"""Retail sales marts as Spark DataFrame jobs."""
