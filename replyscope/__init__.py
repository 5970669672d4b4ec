"""Support-conversation analytics on Spark DataFrames."""
