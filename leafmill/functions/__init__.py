"""Column expressions and parsers."""
