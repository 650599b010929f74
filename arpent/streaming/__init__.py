"""Operators on streams of observations."""
