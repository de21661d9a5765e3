"""Batch operators: DataFrames in, DataFrame out, nothing executed unless stated."""
