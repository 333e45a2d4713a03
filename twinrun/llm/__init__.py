"""Operators of a training-data pipeline, each as Spark jobs.

Nothing else in the library imports this subpackage.  Every operator takes
DataFrames plus column names, reads only the columns it names (so extra
columns, whatever they are called, never clash), and returns a DataFrame.
"""
