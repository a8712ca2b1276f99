"""Operators: each one takes DataFrames and returns DataFrames."""
