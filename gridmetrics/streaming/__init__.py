"""Incremental pick-up of newly landed files."""
