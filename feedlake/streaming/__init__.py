"""Incremental pick-up of arriving feeds."""
