"""Structured Streaming scorer."""
