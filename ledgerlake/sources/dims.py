"""Dimension loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.dates import as_date
from ledgerlake.functions.numbers import plain_decimal


def normalise_token_dim(
    df: DataFrame,
    id: str = "id",
    address: str = "address",
    decimals: str = "decimals",
    symbol: str = "symbol",
    supply: str = "total_supply",
    loaded: str = "date_time",
) -> DataFrame:
    """Token dimension: missing id as empty text, address in lower case, supply in plain digits.

    Column names of the result are those of the warehouse table (``total_suply``
    included).
    """
    return df.select(
        F.coalesce(F.col(id), F.lit("")).alias("id"),
        F.lower(F.col(address)).alias("address"),
        F.col(decimals).cast("int").alias("decimals"),
        F.col(symbol).alias("token_symbol"),
        plain_decimal(F.col(supply)).alias("total_suply"),
        F.col(loaded).alias("date_time"),
    )


def load_price_dim(
    df: DataFrame,
    day: str | dt.date | None = None,
    id: str = "id",
    symbol: str = "symbol",
    price: str = "price_us",
    date: str = "time",
) -> DataFrame:
    """Positive prices, of one day if given."""
    kept = df.where(F.col(price) > 0)
    if day is not None:
        kept = kept.where(F.col(date) == F.lit(as_date(day)))
    return kept.select(
        F.col(id).alias("id"),
        F.col(symbol).alias("token_symbol"),
        F.col(price).alias("price_us"),
        F.col(date).alias("transaction_date"),
    )
