"""Operators: functions from DataFrames to a DataFrame, all tickers at once."""
