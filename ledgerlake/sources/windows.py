"""Load control: trailing windows, promotion, late data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.dates import as_date
from ledgerlake.sources.readers import between_days, scan


@dataclass(frozen=True)
class Windows:
    """How many days before the run day each layer is worked on again.

    Late data is handled by recomputing these days and replacing their
    partitions.
    """

    raw: int = 2
    parse: int = 1
    ods: int = 2
    ledger: int = 3

    def since(self, layer: str, day: str | dt.date) -> dt.date:
        return as_date(day) - dt.timedelta(days=getattr(self, layer))


def promote(
    df: DataFrame,
    columns: Sequence[str],
    day: str | dt.date,
    lookback: int,
    date: str = "transaction_date",
) -> DataFrame:
    """The trailing window of a table, projected for the next layer (to be partition-replaced there)."""
    return scan(df, since=as_date(day) - dt.timedelta(days=lookback), column=date).select(*columns)


def backfill(df: DataFrame, month: str | None = None, day: str | None = None, date: str = "transaction_date") -> DataFrame:
    """A backfill slice: one month if given, else one day."""
    if month is None and day is None:
        raise ValueError("give month or day")
    return scan(df, month=month, column=date) if month is not None else scan(df, on=day, column=date)


def replace_window(old: DataFrame, fresh: DataFrame, since: str | dt.date, date: str = "transaction_date") -> DataFrame:
    """What a table holds after the window from ``since`` was recomputed and overwritten.

    Days of the window that the recomputation has no row for keep their old
    rows, as with partition overwrite.
    """
    since = as_date(since)
    window = fresh.where(between_days(fresh, date, since, None))
    days = window.select(F.col(date)).distinct()
    before = old.where(between_days(old, date, None, since - dt.timedelta(days=1)))
    untouched = old.where(between_days(old, date, since, None)).join(days, date, "left_anti")
    return before.unionByName(untouched).unionByName(window)
