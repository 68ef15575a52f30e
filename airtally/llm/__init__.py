"""Operators for preparing training text: filters, joins, scans, models and mixing."""
