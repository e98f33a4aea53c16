"""Operators for training-data pipelines: tokenizing, extraction, dedup, mixing, search, archives."""
