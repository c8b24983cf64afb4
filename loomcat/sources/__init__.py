"""Loaders and sinks."""
