"""Preparing, scoring and evaluating reasoning data as Spark DataFrames."""
