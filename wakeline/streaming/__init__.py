"""Structured Streaming forms of the latest-position and last-hour operators."""
