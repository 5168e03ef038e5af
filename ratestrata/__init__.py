"""Layered (bronze, silver, gold) analytics over daily rate series, on Spark DataFrames."""
