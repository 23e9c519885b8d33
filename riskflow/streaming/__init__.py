"""Structured Streaming jobs of the three layers."""
