"""Readers and generators."""
