"""Relational operators over listing DataFrames (DataFrame -> DataFrame)."""
