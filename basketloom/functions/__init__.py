"""Column expressions and user-defined functions."""
