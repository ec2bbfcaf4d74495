"""Operators for training-data pipelines: scoring, deduplication, scans, search and encoding."""
