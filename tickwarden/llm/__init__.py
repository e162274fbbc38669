"""Operators for preparing training text: scoring, cleaning, deduplication, formats, tokens."""
