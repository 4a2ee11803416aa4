"""Readers, writers and the adapters that build listing tables."""
