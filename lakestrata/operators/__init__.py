"""Operators on whole DataFrames: duplicates, keys, joins, windows and quality checks."""
