"""Streaming twin of the raw-log load."""
