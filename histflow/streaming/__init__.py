"""Incremental pickup of landing rows with Structured Streaming."""
