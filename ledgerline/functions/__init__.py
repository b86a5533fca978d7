"""Column expressions and registered functions."""
