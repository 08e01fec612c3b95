"""Queries over the given tables, and the daily and backfill runs of a warehouse."""
