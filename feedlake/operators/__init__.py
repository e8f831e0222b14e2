"""Filters, joins, the row pipeline, sinks and run records."""
