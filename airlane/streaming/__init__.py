"""Structured Streaming queries over the message log."""
