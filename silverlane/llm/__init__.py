"""Operators of a training-data pipeline: duplicates, mixing, contamination, scores, shards and token files."""
