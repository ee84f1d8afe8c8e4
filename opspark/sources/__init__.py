"""Schemas, readers, sinks and fitted-state tables."""
