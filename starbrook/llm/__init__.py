"""Operators that prepare training data: filtering, deduplication, tokenisation, packing."""
