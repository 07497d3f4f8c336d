"""Structured Streaming versions of bar building and scoring."""
