"""Column expressions: dates and scalars."""
