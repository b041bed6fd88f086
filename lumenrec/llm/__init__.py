"""Operators for large text collections: cleaning, deduplication, scoring, packing."""
