"""Operators from DataFrames to DataFrame."""
