"""Retail warehouse building and OLAP reporting as Spark DataFrame jobs."""
