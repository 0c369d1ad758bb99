"""Structured Streaming jobs: wire stream -> parse -> clean -> lake / serving table."""
