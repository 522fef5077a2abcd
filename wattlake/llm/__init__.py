"""Operators of a training-data pipeline (near-duplicates, search, scans, mixing)."""
