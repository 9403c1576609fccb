"""Operators: DataFrame -> DataFrame functions with column-name parameters."""
