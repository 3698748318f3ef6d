"""Governed read-models, scoped retrieval and audit on Spark DataFrames."""
