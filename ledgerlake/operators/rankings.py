"""Most active participants per token."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.dates import as_date
from ledgerlake.operators.entities import BOTH_SIDES, participants
from ledgerlake.operators.metrics import DATE, TOKEN
from ledgerlake.sources.readers import between_days

TOP = 100


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, spread: Sequence[str] = ()) -> DataFrame:
    """The first ``k`` rows of each group; a hot group never reaches one task whole.

    The first round works within 64 slices of each group, made from the
    ``spread`` columns, so it does not count on a cut before the shuffle.
    """

    def cut(rows: DataFrame, group: list[str]) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        return rows.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")

    if spread:
        sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*spread), F.lit(64)))
        df = cut(sliced, [*by, "_slice"]).drop("_slice")
    return cut(df, list(by))


def top_participants(
    ledger: DataFrame,
    day: str | dt.date,
    days_back: int = 0,
    k: int = TOP,
    sides: Sequence[str] = BOTH_SIDES,
) -> DataFrame:
    """Top ``k`` addresses per token by participations in [day - days_back, day].

    Both sides count, so a self-transfer counts twice; equal counts are ordered
    by address.
    """
    day = as_date(day)
    window = ledger.where(between_days(ledger, DATE, day - dt.timedelta(days=days_back), day))
    counts = participants(window, sides, [TOKEN]).groupBy("customer_address", TOKEN).agg(
        F.count("*").alias("value_num")
    )
    ranked = top_k(counts, [TOKEN], [F.desc("value_num"), F.asc("customer_address")], k, ["customer_address"])
    return ranked.select("value_num", "customer_address", TOKEN, F.lit(day).alias(DATE))


# Stretches of days are cut at multiples of these numbers of days.
SPANS = tuple(1 << level for level in range(6))


def _pieces(start: Column, stop: Column) -> Column:
    """The days start <= day < stop as aligned spans: at most two of each length but the longest."""
    parts = []
    for level, days in enumerate(SPANS):
        first, last = F.ceil(start / days).cast("int"), F.floor(stop / days).cast("int")
        span = lambda number: F.struct(F.lit(level).alias("level"), number.alias("number"))  # noqa: B023 (used here only)
        if days == SPANS[-1]:
            inner = F.transform(F.sequence(first, last - 1), span)
            parts.append(F.when(first < last, inner).otherwise(F.slice(F.array(span(first)), 1, 0)))
        else:
            parts.append(F.filter(F.array(F.when((first < last) & (first.bitwiseAND(F.lit(1)) == 1), span(first))), lambda x: x.isNotNull()))
            parts.append(F.filter(F.array(F.when((first < last) & (last.bitwiseAND(F.lit(1)) == 1), span(last - 1))), lambda x: x.isNotNull()))
    return F.concat(*parts)


# Tokens share this many rows of lower bounds, so that their table stays small however many tokens there are.
BOUND_ROWS = 256


def _bound_row() -> Column:
    return F.pmod(F.xxhash64(TOKEN), F.lit(BOUND_ROWS)).cast("int")


def _rounded(count: Column) -> Column:
    """The count with its leading six bits, never more than the count: few values, however wide the counts."""
    low = F.greatest(F.floor(F.log2(count)).cast("int") - 5, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", count, low), low)


def _lower_bounds(steps: DataFrame, begin: Column, end: Column, k: int) -> DataFrame:
    """One row, one list: per row of bounds and day from ``begin`` to ``end`` a count that the best ``k`` of every token reach.

    How many addresses have a count on a day follows from the starts and ends of
    the stretches alone, so they are added up before they are shuffled.
    """
    edges = F.inline(F.array(*[F.struct(F.col(at).alias("day"), F.lit(by).alias("by")) for at, by in (("start", 1), ("stop", -1))]))
    changes = steps.select(TOKEN, _rounded(F.col("value_num")).alias("count"), edges)
    changes = changes.groupBy(TOKEN, "count", "day").agg(F.sum("by").alias("by"))
    in_time = Window.partitionBy(TOKEN, "count").orderBy("day")
    held = changes.select(TOKEN, "count", "day", F.lead("day").over(in_time).alias("next"), F.sum("by").over(in_time).alias("n"))
    each_day = F.explode(F.sequence("day", F.col("next") - 1)).alias("day")
    held = held.where(F.col("n") > 0).select(TOKEN, "count", "n", each_day)
    above = F.sum("n").over(Window.partitionBy(TOKEN, "day").orderBy(F.desc("count")))
    reached = held.select(TOKEN, "day", F.when(above >= k, F.col("count")).otherwise(0).alias("least"))
    least = reached.groupBy(TOKEN, "day").agg(F.max("least").alias("least")).select(_bound_row().alias("row"), "day", "least")
    every = F.explode(F.sequence(F.unix_date(begin), F.unix_date(end))).alias("day")
    grid = steps.sparkSession.range(BOUND_ROWS).select(F.col("id").cast("int").alias("row"), every, F.lit(None).cast("bigint").alias("least"))
    filled = grid.unionByName(least).groupBy("row", "day").agg(F.coalesce(F.min("least"), F.lit(0)).alias("least"))
    in_order = lambda *by: F.array_sort(F.collect_list(F.struct(*by)))
    rows = filled.groupBy("row").agg(F.transform(in_order("day", "least"), lambda x: x["least"]).alias("bounds"))
    return rows.agg(F.flatten(F.transform(in_order("row", "bounds"), lambda x: x["bounds"])).alias("bounds"))


def top_participants_history(
    ledger: DataFrame,
    days_back: int = 0,
    k: int = TOP,
    sides: Sequence[str] = BOTH_SIDES,
    first: str | dt.date | None = None,
    last: str | dt.date | None = None,
) -> DataFrame:
    """``top_participants`` of every day from ``first`` to ``last`` (else of the ledger's own days) in one plan.

    A day's participations enter the trailing window on the day and leave it
    ``days_back + 1`` days later, so an address has one running count, constant
    between such days. Stretches whose count is on none of their days among the
    best ``k`` counts of the token go first. Each other stretch is cut into aligned
    spans of 1 to 32 days; of the addresses that cover a span only the best ``k``
    can be among the best of a day in it. What is left, at most ``k`` addresses a
    span, is laid out day by day.
    """
    keys = ["customer_address", TOKEN]
    ledger = ledger.where(F.col(DATE).isNotNull())
    bounds = ledger.agg(F.min(DATE).alias("first"), F.max(DATE).alias("last"))
    begin = F.lit(as_date(first)) if first is not None else bounds.select("first").scalar()
    end = F.lit(as_date(last)) if last is not None else bounds.select("last").scalar()
    if first is not None or last is not None:
        reach = None if first is None else as_date(first) - dt.timedelta(days=days_back)
        ledger = ledger.where(between_days(ledger, DATE, reach, None if last is None else as_date(last)))
    number = F.unix_date(DATE)
    daily = participants(ledger, sides, [TOKEN, DATE]).groupBy(*keys, number.alias("day")).agg(F.count("*").alias("n"))
    events = daily.repartition(*keys).select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.col("day").alias("start"), F.col("n").alias("change")),
                F.struct((F.col("day") + days_back + 1).alias("start"), (-F.col("n")).alias("change")),
            )
        ),
    )
    order = Window.partitionBy(*keys).orderBy("start")
    steps = events.select(
        *keys,
        F.greatest("start", F.unix_date(begin)).alias("start"),
        F.least(F.lead("start").over(order), F.unix_date(end) + 1).alias("stop"),
        F.sum("change").over(order).alias("value_num"),  # rows of one day count together
    )
    steps = steps.where((F.col("value_num") > 0) & (F.col("start") < F.col("stop")))
    bounds = _lower_bounds(steps, begin, end, k).scalar()
    first_day, days = F.unix_date(begin), F.unix_date(end) - F.unix_date(begin) + 1
    at = _bound_row() * days + F.col("start") - first_day + 1
    steps = steps.where(F.col("value_num") >= F.array_min(F.slice(bounds, at, F.col("stop") - F.col("start"))))
    spans = steps.select("value_num", *keys, F.inline(_pieces(F.col("start"), F.col("stop"))))
    best = [F.desc("value_num"), F.asc("customer_address")]
    spans = top_k(spans, [TOKEN, "level", "number"], best, k, ["customer_address"])
    days = F.element_at(F.array(*map(F.lit, SPANS)), F.col("level") + 1)
    day = F.explode(F.sequence(F.col("number") * days, (F.col("number") + 1) * days - 1))
    ranked = top_k(spans.select("value_num", *keys, day.alias("day")), [TOKEN, "day"], best, k)
    return ranked.select("value_num", *keys, F.date_from_unix_date("day").alias(DATE))
