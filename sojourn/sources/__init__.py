"""Readers, landing jobs and table sinks."""
