"""Schemas, the source registry, staged and versioned tables, analogue views."""
