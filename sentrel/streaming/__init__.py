"""Structured Streaming forms of the main jobs."""
