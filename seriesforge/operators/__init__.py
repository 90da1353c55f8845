"""Operators: a DataFrame in, a DataFrame out."""
