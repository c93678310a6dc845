"""Landed collections, file and table sinks, and the adapter for the star-schema tables."""
