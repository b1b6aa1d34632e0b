"""Maintenance analytics on Spark DataFrames."""
