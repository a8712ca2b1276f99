"""Readers, adapter views over the given tables, and sinks."""
