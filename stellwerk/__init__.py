"""Spark operators for streams of job advertisements.

Every operator is a function from DataFrames (or Columns) to a DataFrame (or
Column).  Nothing here holds state of its own: tables live where the caller
keeps them, and "today" is always a parameter.
"""
