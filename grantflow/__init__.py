"""Relationship-based access analytics on Spark DataFrames."""
