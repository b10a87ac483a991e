"""Operators of a training-data pipeline: mixing, deduplication, filtering, scrubbing, counting and packing."""
