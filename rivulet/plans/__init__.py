"""Whole pipelines as builders, and the registry of queries."""
