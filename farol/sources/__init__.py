"""Readers, the demonstration mapping onto the star-schema tables, and sinks."""
