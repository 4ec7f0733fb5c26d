"""Reusable relational operators: DataFrames in, one lazy DataFrame out."""
