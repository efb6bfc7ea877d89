"""Partitioned event logs as Spark DataFrames, in batch and in Structured Streaming."""
