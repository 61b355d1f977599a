"""Operators of a training-data pipeline: dedup, decontamination, tokenising, scoring, filters."""
