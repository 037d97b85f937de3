"""Circular-trade analytics on Spark DataFrames."""
