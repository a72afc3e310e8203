"""Structured Streaming: the cleaning query, keyed state, windows."""
