"""Structured Streaming jobs that keep the search index current."""
