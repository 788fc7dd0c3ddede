"""The named analyses: each takes DataFrames and returns a DataFrame."""
