"""Streaming runs of the same transformations."""
