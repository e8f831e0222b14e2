"""Readers: feed files, control files, allow-lists and the warehouse catalog."""
