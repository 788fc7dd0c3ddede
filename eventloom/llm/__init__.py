"""Operators of a pipeline that prepares training data: whole texts in, whole results out.

Every operator takes and returns DataFrames. Nothing outside this package imports it.
"""
