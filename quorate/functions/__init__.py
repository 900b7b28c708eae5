"""Column expressions: collections, text, keys, geometry."""
