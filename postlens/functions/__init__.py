"""Column expressions: text, calendar and keyed hashing."""
