"""Bibliographic analytics and corpus preparation on PySpark."""
