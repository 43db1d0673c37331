"""Operators that prepare training data: deduplication, filtering, tokens, packing, search."""
