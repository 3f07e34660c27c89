"""Portfolio returns on Spark DataFrames."""
