"""Operators of a training-data pipeline: filters, search, near-duplicates, token files, packing."""
