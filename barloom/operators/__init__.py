"""Operators: DataFrame in, DataFrame out, lazy, no driver-side data."""
