"""Readings as they arrive."""
