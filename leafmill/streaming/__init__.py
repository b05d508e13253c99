"""Incremental runs as streams."""
