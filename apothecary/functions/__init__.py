"""Column expressions: null-aware aggregates, scalars, text formats."""
