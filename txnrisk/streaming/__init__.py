"""Structured Streaming queries that drive the plans."""
