"""Operators of a training-data pipeline: token files, deduplication, filtering, mixing, sharding."""
