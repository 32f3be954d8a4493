"""Batch ELT and dimensional analytics operators for Spark DataFrames."""
