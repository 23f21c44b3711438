"""Span, layout and training-data analytics on Spark DataFrames."""
