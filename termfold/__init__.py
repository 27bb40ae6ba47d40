"""Coarsening and grouping of coded laboratory terms on Spark DataFrames."""
