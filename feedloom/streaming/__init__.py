"""Structured Streaming jobs over the same plans."""
