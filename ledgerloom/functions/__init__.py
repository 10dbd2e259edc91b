"""Column expressions: numbers, text and cell arrays."""
