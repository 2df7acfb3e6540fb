"""Operators for building training data: deduplication, filtering, extraction and packing."""
