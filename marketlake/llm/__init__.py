"""Operators for training data: filters, deduplication, search, mixing and packing."""
