"""Operators for preparing training text: deduplication, sharding, mixing, tokens, quality."""
