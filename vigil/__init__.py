"""Hourly patient-monitoring analytics on Spark: DataFrames in, DataFrames out."""
