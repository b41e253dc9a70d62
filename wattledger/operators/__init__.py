"""Operators: functions from DataFrames to a DataFrame, with an explicit as-of date where time matters."""
