"""Contribution-and-place analytics on Spark DataFrames."""
