"""Battle-game rules and data processing over Spark DataFrames."""
