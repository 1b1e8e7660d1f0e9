"""Readers and writers for the file formats at the edges of a pipeline."""
