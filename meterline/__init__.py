"""Batch analytics over trip-like fact tables, written as PySpark DataFrame code."""
