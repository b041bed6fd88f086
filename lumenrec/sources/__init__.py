"""Readers: source catalogue, dated layouts, vector text, snapshots."""
