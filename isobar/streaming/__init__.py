"""Structured Streaming versions of the feeds."""
