"""Operators over DataFrames: cleaning, profiling, splitting, encoding, evaluation, ranking."""
