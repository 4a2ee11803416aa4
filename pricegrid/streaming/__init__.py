"""Structured Streaming jobs: request scoring and quality counters."""
