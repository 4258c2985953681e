"""Incremental medallion warehouse for sensor readings, built on Spark DataFrames."""
