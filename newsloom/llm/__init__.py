"""Operators of a training-data pipeline: scoring, dedup, mixing, search, scans, tokenising."""
