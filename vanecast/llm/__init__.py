"""Operators of a training-data pipeline: dedup, decontamination, filters, mixing, extraction."""
