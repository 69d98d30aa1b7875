"""Operators for building training data: packing, dedup, filters, scans, mixing, extraction."""
