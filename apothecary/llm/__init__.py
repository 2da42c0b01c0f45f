"""Operators of a training-data pipeline: scoring, deduplication, mixing, encoding, search."""
