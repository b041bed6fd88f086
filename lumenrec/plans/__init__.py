"""Derived inputs, jobs and the query registry."""
