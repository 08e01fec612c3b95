"""Scans, dimension loads, sinks and load windows."""
