"""Click-log recommendation analytics on Spark DataFrames."""
