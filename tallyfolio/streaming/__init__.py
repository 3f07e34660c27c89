"""Incremental pick-up of landed files."""
