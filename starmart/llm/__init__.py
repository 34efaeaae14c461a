"""Operators of a training-data pipeline: language, duplicates, quality, secrets, mixing, packing."""
