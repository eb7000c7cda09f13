"""Operators for training-data pipelines over a ``documents`` table.

Nothing outside this package imports it. Every operator takes DataFrames and returns
DataFrames; ``queries`` registers one production query for each of them.
"""
