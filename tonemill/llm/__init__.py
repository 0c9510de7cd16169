"""Operators for preparing training data: dedup, filters, mixing, sharding and search."""
