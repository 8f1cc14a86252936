"""Operators for large training-data pipelines over a table of documents.

Nothing else in the library imports this subpackage. Every operator takes DataFrames and returns a
lazy DataFrame; only the id and text columns it names are read, so further columns (whatever their
names) never reach it.
"""
