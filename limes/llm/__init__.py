"""Operators for preparing training data: deduplication, filters, mixing, packing, media columns."""
