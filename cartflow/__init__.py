"""cartflow: e-commerce order analytics on Spark DataFrames."""
