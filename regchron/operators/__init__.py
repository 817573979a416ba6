"""Operators over DataFrames: staging, history, watermark, lookup join and quality checks."""
