"""Operators of a training-data pipeline: extraction, scans, joins, mixing, encoding."""
