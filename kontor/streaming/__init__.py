"""Incremental loads from a stream."""
