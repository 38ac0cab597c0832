"""Readers of payloads, events and tables."""
