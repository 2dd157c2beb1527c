"""Operators for building training data: archives, cleaning, scoring, dedup, tokens, packing."""
