"""Operators of a training-data pipeline: extraction, deduplication, scoring, filtering and mixing of texts."""
