"""DataFrame operators: each a function of DataFrames and parameters."""
