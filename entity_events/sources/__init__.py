"""Readers: change feed, registries, and the adapter for the supplied tables."""
