"""Operators for building training corpora from the same tables. Nothing outside this folder imports it."""
