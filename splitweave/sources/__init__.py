"""Readers: snapshots, mapping, file inventory, catalog."""
