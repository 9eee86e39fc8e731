"""Operators for preparing language-model training data, each on plain Spark DataFrames."""
