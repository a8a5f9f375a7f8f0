"""Operators of a training-data pipeline: tokens, scores, near duplicates, packing."""
