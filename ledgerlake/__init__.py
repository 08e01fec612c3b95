"""Ledger analytics on Spark: raw block documents to priced ledgers to token metrics."""

__version__ = "0.1.0"
