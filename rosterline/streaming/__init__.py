"""Incremental pick-up of new snapshot files."""
