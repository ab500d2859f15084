"""Retail marketplace warehouse jobs on PySpark."""
