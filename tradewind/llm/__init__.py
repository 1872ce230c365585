"""Operators for preparing training data: filtering, deduplication, mixing, tokenising and packing."""
