"""Operators: DataFrames and keyword parameters in, a DataFrame out."""
