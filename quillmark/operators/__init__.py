"""Operators over any tables of the right shape; every one takes DataFrames and returns a DataFrame."""
