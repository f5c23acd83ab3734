"""Operators for preparing training text: search, packing, extraction, deduplication, scoring, formatting."""
