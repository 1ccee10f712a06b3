"""Operators of a training-data pipeline: scoring, search, packing, filters."""
