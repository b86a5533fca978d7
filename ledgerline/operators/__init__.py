"""Composite operators: DataFrame in, DataFrame out."""
