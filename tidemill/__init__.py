"""Batch analytics operators for Spark DataFrames."""
