"""Per-token metrics by hour, day, week and month.

With ``day`` a metric covers the period of that day so far (incremental run);
without it, all of history (backfill).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerlake.functions.dates import as_date, hour_key, hour_stamp, period, period_range
from ledgerlake.functions.numbers import plain_decimal
from ledgerlake.operators.spine import fill, spine_hours, spine_periods
from ledgerlake.operators.sums import add_up, sum_by
from ledgerlake.sources.readers import between_days, scan

TOKEN = "token_address"
DATE = "transaction_date"
MEASURES = ("volume", "amount", "trades", "new_addresses")


def measured(ledger: DataFrame, keys: Sequence[str], measure: str, value: str = "value", amount: str = "amount") -> DataFrame:
    """The keys and ``value_num``: ``volume`` sums values, ``amount`` priced amounts (no price counts 0), the others count rows."""
    if measure in ("volume", "amount"):
        summed = sum_by(ledger, keys, value if measure == "volume" else amount)
        return summed.select(*keys, F.coalesce("total", F.lit(0.0)).alias("value_num"))
    if measure in ("trades", "new_addresses"):
        return ledger.groupBy(*keys).agg(F.count("*").alias("value_num"))
    raise ValueError(f"measure must be one of {MEASURES}, not {measure!r}")


def rollup_metric(
    ledger: DataFrame,
    spine: DataFrame,
    measure: str,
    grain: str = "day",
    day: str | dt.date | None = None,
    value: str = "value",
    amount: str = "amount",
) -> DataFrame:
    """One measure per token and period on the spine.

    An incremental week is week-to-date (Monday up to ``day``) for the tokens
    listed on the day; an incremental month takes all rows of the month, for the
    tokens listed in it. ``new_addresses`` takes a first-seen table as ledger.
    """
    if day is not None:
        first, last = period_range(day, grain)
        ledger = ledger.where(between_days(ledger, DATE, first, last))
        listed = (first, last) if grain == "month" else (as_date(day), as_date(day))
        spine = spine.where(between_days(spine, DATE, *listed))
    keys = [TOKEN, DATE]
    totals = measured(ledger.withColumn(DATE, period(F.col(DATE), grain)), keys, measure, value, amount)
    return fill(spine_periods(spine, grain), totals, keys).select("value_num", *keys)


def rollup_grains(
    ledger: DataFrame, spine: DataFrame, measure: str, value: str = "value", amount: str = "amount"
) -> DataFrame:
    """Day, week and month of one additive measure from a single scan of the ledger.

    The daily totals are aggregated once (their shuffle is reused) and weeks and
    months are rolled up from them.
    """
    keys = [TOKEN, DATE]
    column = {"volume": value, "amount": amount}.get(measure)
    daily = _daily(ledger, column)
    parts = []
    for grain in ("day", "week", "month"):
        totals = _rolled(daily.withColumn(DATE, period(F.col(DATE), grain)), keys, column)
        part = fill(spine_periods(spine, grain), totals, keys)
        parts.append(part.select("value_num", *keys, F.lit(grain).alias("grain")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _daily(ledger: DataFrame, column: str | None) -> DataFrame:
    """Exact ``total`` per token and day, so that days add up without rounding: rows counted, decimals with room, else text."""
    keys = [TOKEN, DATE]
    if column is None:
        return ledger.groupBy(*keys).agg(F.count("*").alias("total"))
    kind = ledger.schema[column].dataType
    if isinstance(kind, DecimalType) and kind.precision <= 18:
        return ledger.groupBy(*keys).agg(F.sum(F.col(column).cast(f"decimal(18,{kind.scale})")).alias("total"))
    return add_up(ledger.withColumn(column, plain_decimal(F.col(column))), keys, column).select(*keys, "total")


def _rolled(days: DataFrame, keys: Sequence[str], column: str | None) -> DataFrame:
    """Daily totals added up to ``value_num`` per keys."""
    if column is None:
        return days.groupBy(*keys).agg(F.sum("total").alias("value_num"))
    return sum_by(days, keys, "total").select(*keys, F.coalesce("total", F.lit(0.0)).alias("value_num"))


def rollup_range(
    ledger: DataFrame,
    spine: DataFrame,
    measure: str,
    grain: str,
    first: str | dt.date,
    last: str | dt.date,
    value: str = "value",
    amount: str = "amount",
) -> DataFrame:
    """What the incremental runs of all days ``first``..``last`` give, in one plan; ``run_date`` tells them apart.

    The range and what its first period needs are read once and cut to a row per
    token and day. A day's total then counts for the run days from that day to
    the end of its week (seven at most); a month's total for all run days in it.
    """
    first, last = as_date(first), as_date(last)
    begin, end = period_range(first, grain)[0], period_range(last, grain)[1] if grain == "month" else last
    column = {"volume": value, "amount": amount}.get(measure)
    daily = _daily(ledger.where(between_days(ledger, DATE, begin, end)), column)
    run_days = lambda low, high: F.sequence(F.greatest(low, F.lit(first)), F.least(high, F.lit(last)))
    keys = [TOKEN, DATE, "run_date"]
    if grain == "month":
        listed = spine_periods(spine.where(between_days(spine, DATE, begin, end)), grain)
        totals = _rolled(daily.withColumn(DATE, period(F.col(DATE), grain)), [TOKEN, DATE], column)
        filled = fill(listed, totals, [TOKEN, DATE])
        return filled.select("value_num", TOKEN, DATE, F.explode(run_days(F.col(DATE), F.last_day(DATE))).alias("run_date"))
    stop = F.col(DATE) if grain == "day" else F.date_add(period(F.col(DATE), "week"), 6)
    counted = daily.where((stop >= F.lit(first)) & (F.col(DATE) <= F.lit(last)))
    counted = counted.select(TOKEN, period(F.col(DATE), grain).alias(DATE), F.explode(run_days(F.col(DATE), stop)).alias("run_date"), "total")
    listed = spine.where(between_days(spine, DATE, first, last))
    listed = listed.select(TOKEN, period(F.col(DATE), grain).alias(DATE), F.col(DATE).alias("run_date"))
    return fill(listed, _rolled(counted, keys, column), keys).select("value_num", *keys)


def avg_metric(
    ledger: DataFrame,
    spine: DataFrame,
    column: str = "value",
    day: str | dt.date | None = None,
    positive: bool = False,
) -> DataFrame:
    """Sum over row count per token and day; ``positive`` counts only rows above zero."""
    if day is not None:
        ledger, spine = scan(ledger, on=day), scan(spine, on=day)
    if positive:
        ledger = ledger.where(F.col(column).cast("double") > 0)
    mean = F.coalesce("total", F.lit(0.0)) / F.col("n")
    totals = sum_by(ledger, [TOKEN, DATE], column).select(TOKEN, DATE, mean.alias("value_num"))
    return fill(spine.select(TOKEN, DATE), totals, [TOKEN, DATE]).select("value_num", TOKEN, DATE)


def hourly_metric(
    ledger: DataFrame,
    spine: DataFrame,
    measure: str,
    day: str | dt.date | None = None,
    ts: str = "date_time",
    value: str = "value",
    amount: str = "amount",
) -> DataFrame:
    """One measure per token and hour on the hour spine.

    For a ``day``, hours after the latest one with data are left out; a backfill
    has all 24 hours of every listed day. ``transaction_date`` is the hour stamp,
    ``trade_date`` the day.
    """
    if day is not None:
        ledger, spine = scan(ledger, on=day), scan(spine, on=day)
    hours = spine_hours(spine.select(TOKEN, DATE))
    timed = ledger.withColumn("dh", hour_key(F.col(ts)))
    if day is not None:
        hours = hours.where(F.col("dh") <= timed.agg(F.max("dh").alias("latest")).scalar())
    keys = [TOKEN, DATE, "dh"]
    totals = measured(timed, keys, measure, value, amount)
    return fill(hours, totals, keys).select(
        "value_num",
        TOKEN,
        hour_stamp(F.col(DATE), F.col("dh")).alias(DATE),
        F.col(DATE).alias("trade_date"),
    )


def new_addresses(first_seen: DataFrame, keys: Sequence[str] = (), day: str | dt.date | None = None) -> DataFrame:
    """First-seen rows per day (and ``keys``), days without any left out."""
    if day is not None:
        first_seen = scan(first_seen, on=day)
    return first_seen.groupBy(*keys, DATE).agg(F.count("*").alias("value_num")).select("value_num", *keys, DATE)
