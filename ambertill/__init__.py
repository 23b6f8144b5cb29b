"""Retail, rental and network analytics written as Spark DataFrame jobs."""
