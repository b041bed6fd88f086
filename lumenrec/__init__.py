"""Recommendation and search-index jobs written as Spark DataFrame operations."""
