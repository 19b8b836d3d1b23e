"""Card-transaction risk analytics on Spark DataFrames and Structured Streaming."""
