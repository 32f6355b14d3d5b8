"""Event and counter telemetry analytics on Spark DataFrames."""
