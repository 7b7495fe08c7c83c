"""Training-data operators: text, pages and token tables in, DataFrames out.

Nothing else in the library imports this subpackage.
"""
