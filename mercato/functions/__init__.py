"""Column functions: tolerant casts, JSON scalars, personal-data techniques."""
