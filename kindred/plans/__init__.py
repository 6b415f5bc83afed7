"""Operators put together over the given tables."""
