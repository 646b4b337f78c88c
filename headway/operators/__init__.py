"""Operators: DataFrame -> DataFrame transformations."""
