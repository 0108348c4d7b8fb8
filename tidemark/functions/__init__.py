"""Column expressions: text folding, names, URLs, casts, series."""
