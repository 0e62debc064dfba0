"""Metered-usage and session-accounting jobs on Spark DataFrames."""
