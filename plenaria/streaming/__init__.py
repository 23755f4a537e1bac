"""Structured Streaming jobs over the change feed."""
