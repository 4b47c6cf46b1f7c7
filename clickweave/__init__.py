"""Click-to-view attribution on Spark DataFrames and Structured Streaming."""
