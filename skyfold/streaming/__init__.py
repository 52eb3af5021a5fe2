"""Structured Streaming intake of newly landed raw batches."""
