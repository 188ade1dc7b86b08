"""Operators for building training corpora: scoring, cleaning, deduplication, mixing, sharding."""
