"""Relational operators of the lake: DataFrames in, DataFrames out."""
