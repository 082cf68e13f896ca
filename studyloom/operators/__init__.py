"""Operators: DataFrame to DataFrame, or to a main result and its exceptions."""
