"""Arrivals star mart: monthly arrival records to a star schema, on Spark DataFrames."""
