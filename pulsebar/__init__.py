"""Market and social time-bucket analytics on Spark DataFrames."""
