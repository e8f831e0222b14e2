"""Operators of a training-data pipeline: rules, repeats, scores, scans, packing, extraction."""
