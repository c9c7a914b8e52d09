"""Readers, loaders and sinks."""
