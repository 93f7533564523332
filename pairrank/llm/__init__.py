"""Operators for preparing language-model training text, on Spark DataFrames.

Nothing else in the library imports this subpackage.  Every operator takes
DataFrames with the columns it names, ignores any others, and returns a
DataFrame; ``queries`` holds the thin named queries.
"""
