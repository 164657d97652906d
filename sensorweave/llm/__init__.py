"""Operators for training-data preparation (deduplication, filtering, packing)."""
