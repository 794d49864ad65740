"""Operators over record, candidate and score tables."""
