"""Batch machine-learning data jobs expressed as Spark DataFrames."""
