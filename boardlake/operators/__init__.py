"""Relational operators of the pipeline; each maps DataFrames to a DataFrame."""
