"""Route-network analytics on Spark DataFrames."""
