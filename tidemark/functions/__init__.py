"""Column expressions: keys, text, dates and numbers."""
