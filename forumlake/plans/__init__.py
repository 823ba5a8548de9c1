"""The models, metrics and reports, each a function from DataFrames to a DataFrame."""
