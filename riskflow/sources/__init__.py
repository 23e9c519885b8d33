"""Readers of the feed, the lookups and the layer tables."""
