"""Column-level functions: text, numbers and similarity."""
