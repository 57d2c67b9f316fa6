"""Operators for building training data: deduplication, filtering, mixing, packing, indexing and materialisation."""
