"""Who took part, and when each address was first seen."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.dates import as_date, hour_key
from ledgerlake.sources.readers import between_days, scan

BOTH_SIDES = ("from_address", "to_address")


def participants(
    ledger: DataFrame,
    sides: Sequence[str] = BOTH_SIDES,
    keep: Sequence[str] = ("token_address", "date_time", "transaction_date"),
) -> DataFrame:
    """One row per side of every movement, from a single scan."""
    return ledger.select(F.explode(F.array(*sides)).alias("customer_address"), *keep)


def first_seen(
    ledger: DataFrame,
    keys: Sequence[str] = ("token_address",),
    sides: Sequence[str] = BOTH_SIDES,
    day: str | dt.date | None = None,
    known: DataFrame | None = None,
    ts: str = "date_time",
    date: str = "transaction_date",
) -> DataFrame:
    """Earliest time of each address (and ``keys``).

    Without ``day``: over the whole ledger. With ``day``: addresses of that day
    that ``known`` (the table so far) does not hold from an earlier date, so a
    re-run of the day gives the same rows.

    Only the time is aggregated, because hour and date follow from it: a
    fixed-width minimum stays in the hash aggregate and is combined before the
    shuffle, however often one address occurs.
    """
    if (day is None) != (known is None):
        raise ValueError("day and known go together")
    slice_ = ledger if day is None else scan(ledger, on=day, column=date)
    group = ["customer_address", *keys]
    earliest = participants(slice_, sides, [*keys, ts]).groupBy(*group).agg(F.min(ts).alias("date_time"))
    if known is not None:
        before = known.where(between_days(known, "transaction_date", None, as_date(day) - dt.timedelta(days=1)))
        earliest = earliest.join(before.select(*group), group, "left_anti")
    return earliest.select(
        *group,
        hour_key(F.col("date_time")).alias("dh"),
        "date_time",
        F.to_date("date_time").alias("transaction_date"),
    )
