"""Jobs and their building blocks: DataFrames in, DataFrame out."""
