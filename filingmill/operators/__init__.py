"""Fact-extraction operators; each maps DataFrames to DataFrames."""
