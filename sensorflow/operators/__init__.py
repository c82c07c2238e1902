"""Batch operators: each takes a DataFrame plus column names and returns a DataFrame."""
