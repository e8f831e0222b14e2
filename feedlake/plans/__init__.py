"""Whole loads put together from sources and operators."""
