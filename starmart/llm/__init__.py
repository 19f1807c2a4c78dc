"""Operators of a training-data pipeline: dedup, language, decontamination, tokens."""
