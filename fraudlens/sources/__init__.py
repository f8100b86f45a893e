"""Readers, sinks, catalogues and run records."""
