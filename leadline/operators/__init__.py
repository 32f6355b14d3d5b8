"""Operators: functions from DataFrames to DataFrames, columns given by name."""
