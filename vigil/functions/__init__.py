"""Column-level rules built from Spark's own functions."""
