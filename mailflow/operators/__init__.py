"""Mail operators: DataFrames in, DataFrame out."""
