"""Operators for training data: every one takes and returns DataFrames."""
