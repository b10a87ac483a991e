"""Spark analytics operators: DataFrame in, DataFrame out."""
