"""Registered queries, their SQL equivalents and the staged batch job."""
