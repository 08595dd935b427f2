"""Streaming variants of the batch sources."""
