"""Structured Streaming jobs around the shared operators."""
