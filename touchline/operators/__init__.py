"""Operators over DataFrames, generic in their column names."""
