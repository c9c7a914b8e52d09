"""Column functions: patterns of the documents and scalar normalisers."""
