"""Operators that prepare training text: mixing, formatting, counting, deduplication, scans, rules."""
