"""Structured Streaming twins of the time-bucket operators."""
