"""Operators on DataFrames; column names are parameters."""
