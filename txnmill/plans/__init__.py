"""Whole loads: the only modules that run actions in sequence."""
