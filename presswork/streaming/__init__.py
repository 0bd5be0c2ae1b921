"""Structured Streaming form of the collection queue."""
