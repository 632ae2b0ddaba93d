"""Batch analytics and data movement on Spark DataFrames."""
