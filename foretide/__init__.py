"""Leak-free features, pricing and settlement for time-ordered entity events, on Spark DataFrames."""
