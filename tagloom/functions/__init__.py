"""Column functions: text, list literals, keys, vectors, metric formulas."""
