"""Compositions of the operators: extraction, version comparison and placement plans."""
