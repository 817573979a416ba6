"""Operators for training-data pipelines: deduplication, filtering, tokenising, formatting, scoring."""
