"""Continuous loads."""
