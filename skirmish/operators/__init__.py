"""Rules that take and return DataFrames."""
