"""Operators for building training data: fingerprints, mixing, deduplication, filters, files."""
