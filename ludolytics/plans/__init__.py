"""The queries. Every function takes DataFrames and parameters and gives a DataFrame."""
