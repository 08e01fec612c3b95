"""The token list per period, so that a token without activity shows zero."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.dates import period


def spine_days(
    tokens: DataFrame, first: Column, last: Column, token: str = "token_address", date: str = "transaction_date"
) -> DataFrame:
    """Every token on every date ``first``..``last``; ``tokens`` holds each token once."""
    return tokens.select(F.col(token), F.explode(F.sequence(first, last)).alias(date))


def spine_hours(days: DataFrame) -> DataFrame:
    """Each spine row for hours 00..23, from one scan."""
    hours = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.lpad(h.cast("string"), 2, "0"))
    return days.select("*", F.explode(hours).alias("dh"))


def spine_periods(
    days: DataFrame, grain: str, token: str = "token_address", date: str = "transaction_date"
) -> DataFrame:
    """Every token once per day, week or month it is listed in."""
    if grain == "day":
        return days.select(token, date)
    return days.select(token, period(F.col(date), grain).alias(date)).distinct()


def fill(spine: DataFrame, metric: DataFrame, keys: Sequence[str], value: str = "value_num") -> DataFrame:
    """Metric rows on the spine, zero where there is none."""
    found = metric.select(*keys, value)
    zero = F.lit(0).cast(metric.schema[value].dataType)
    filled = spine.join(found, list(keys), "left")
    return filled.withColumn(value, F.coalesce(value, zero))
