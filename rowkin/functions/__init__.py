"""Column functions: cleaning, field mapping, keys, similarity."""
