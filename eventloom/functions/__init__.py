"""Column expressions and small planning helpers."""
