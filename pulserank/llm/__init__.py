"""Operators of a training-data pipeline: deduplication, decontamination, tokens, filters."""
