"""Column functions: text, formats, vectors and signals."""
