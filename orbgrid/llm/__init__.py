"""Operators for preparing training data: dedup, filters, scoring, mixing, encoding, sharding, search."""
