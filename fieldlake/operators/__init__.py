"""Operators: functions from DataFrames to DataFrames, lazy unless their text says otherwise."""
