"""Table transforms that take and return DataFrames."""
