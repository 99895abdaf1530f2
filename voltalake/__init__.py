"""Spark-native data lake for an electricity trader.

Everything in the package is a function from DataFrames to DataFrames built
on Spark's own expressions. Sessions, dates and paths are arguments.
"""
