"""Incremental (Structured Streaming) loads."""
