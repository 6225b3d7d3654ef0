"""Readers, adapters and table sinks."""
