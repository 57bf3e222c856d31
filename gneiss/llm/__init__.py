"""Operators for training-data pipelines: deduplication, mixing, packing, extraction, scoring."""
