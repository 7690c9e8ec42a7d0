"""Joins, registries, statistics and policies over DataFrames."""
