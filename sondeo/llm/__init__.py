"""Operators that prepare training text: deduplication, extraction, scoring, mixing, packing, search, formatting."""
