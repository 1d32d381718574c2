"""Batch loads, registries, reports and reconcile on Spark DataFrames."""
