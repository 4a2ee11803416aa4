"""Operators over listing tables."""
