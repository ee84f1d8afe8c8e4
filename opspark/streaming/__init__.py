"""Structured Streaming jobs built from the batch column expressions."""
