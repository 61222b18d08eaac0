"""Operators: plain functions over immutable DataFrames."""
