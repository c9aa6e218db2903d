"""Structured Streaming forms of the event and load operators."""
