"""Network availability analytics on Spark DataFrames."""
