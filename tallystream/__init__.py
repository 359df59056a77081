"""Keyed event-stream analytics on Spark DataFrames."""
