"""Incremental (Structured Streaming) forms."""
