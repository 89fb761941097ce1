"""Model-graph analytics on Spark DataFrames."""
