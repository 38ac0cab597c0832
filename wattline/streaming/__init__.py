"""Structured Streaming jobs over grid events."""
