"""Operators for preparing language-model training data.

Every operator takes DataFrames and returns DataFrames; ``queries`` registers one query
per operator over the supplied tables.  Nothing else in the library imports this package.
"""
