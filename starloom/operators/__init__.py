"""Reusable operators on DataFrames."""
