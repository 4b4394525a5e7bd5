"""Table operators: DataFrames and specs in, DataFrame out."""
