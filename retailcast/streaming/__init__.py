"""Incremental roll-ups over daily files with Structured Streaming."""
