"""Readers under explicit schemas."""
