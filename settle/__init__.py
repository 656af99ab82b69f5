"""Half-hourly electricity settlement analytics on Spark DataFrames."""
