"""Continuous forms, on Structured Streaming."""
