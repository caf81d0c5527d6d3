"""Relational operators of the repair: DataFrames in, DataFrames out, no actions unless stated."""
