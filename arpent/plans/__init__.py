"""Composed indicators and classifications."""
