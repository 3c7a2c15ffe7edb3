"""Operators: functions from DataFrames to a DataFrame, with thresholds and names as arguments."""
