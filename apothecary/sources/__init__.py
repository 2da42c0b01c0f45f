"""Readers: warehouse facts, reference files, the sample-table adapter."""
