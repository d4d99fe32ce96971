"""Commercial-property analytics on Spark DataFrames."""
