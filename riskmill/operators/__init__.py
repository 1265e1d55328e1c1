"""Operators: each takes a DataFrame and column names and returns a DataFrame."""
