"""Column expressions: text keys, dates, strict and permissive casts."""
