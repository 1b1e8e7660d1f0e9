"""Structured Streaming variants of the batch filters."""
