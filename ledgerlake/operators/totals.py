"""Running number of addresses."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.dates import as_date
from ledgerlake.operators.metrics import DATE, TOKEN, new_addresses
from ledgerlake.sources.readers import between_days, scan


def running_total(first_seen: DataFrame) -> DataFrame:
    """Addresses seen up to each day that has new ones.

    First-seen rows are counted per day, days are summed up within their year,
    and each year starts from the total of the years before it: no task sees
    more than one year's days.
    """
    year = F.year(DATE).alias("_year")
    daily = new_addresses(first_seen.where(F.col(DATE).isNotNull())).select("value_num", DATE, year)
    # A year's total goes to every later year; there are as many rows as pairs of years.
    totals = daily.groupBy("_year").agg(F.sum("value_num").alias("total"))
    last = F.year(first_seen.agg(F.max(DATE).alias("last")).scalar())
    later = F.when(F.col("_year") < last, F.sequence(F.col("_year") + 1, last))
    before = totals.select(F.explode(later).alias("_year"), "total").groupBy("_year").agg(F.sum("total").alias("before"))
    order = Window.partitionBy("_year").orderBy(DATE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = daily.select("_year", DATE, F.sum("value_num").over(order).alias("within"))
    total = F.col("within") + F.coalesce("before", F.lit(0))
    return within.join(before, "_year", "left").select(total.alias("value_num"), DATE)


def running_total_day(first_seen: DataFrame, prior: DataFrame, day: str | dt.date) -> DataFrame:
    """The latest total before ``day`` plus what is new since then; to be written by partition overwrite.

    Days without new addresses may be missing from ``prior``.
    """
    day = as_date(day)
    latest = prior.where(between_days(prior, DATE, None, day - dt.timedelta(days=1))).agg(
        F.max_by("value_num", DATE).alias("value_num"), F.max(DATE).alias("upto")
    )
    since = latest.select("upto").scalar()
    fresh = first_seen.where(between_days(first_seen, DATE, None, day) & (since.isNull() | (F.col(DATE) > since)))
    both = latest.select("value_num").unionByName(fresh.agg(F.count("*").alias("value_num")))
    return both.agg(F.sum("value_num").alias("value_num")).select("value_num", F.lit(day).alias(DATE))


def running_sum(changes: DataFrame, spine: DataFrame, change: str = "value_num") -> DataFrame:
    """Sum of a token's changes up to each listed day, whether the days before were listed or not.

    The list takes part as rows of zero; one running sum over both, of which the
    listed days are kept. Changes are added up per token and day before that.
    """
    zero = F.lit(0).cast("bigint").alias("value_num")
    marks = spine.select(zero, TOKEN, DATE, F.lit(True).alias("listed"))
    moved = changes.select(F.col(change).alias("value_num"), TOKEN, DATE, F.lit(False).alias("listed"))
    days = moved.unionByName(marks).groupBy(TOKEN, DATE).agg(
        F.sum("value_num").alias("value_num"), F.bool_or("listed").alias("listed")
    )
    upto = Window.partitionBy(TOKEN).orderBy(DATE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = days.select(F.sum("value_num").over(upto).alias("value_num"), TOKEN, DATE, "listed")
    return summed.where("listed").drop("listed")


def running_total_by_token(first_seen: DataFrame, spine: DataFrame) -> DataFrame:
    """Addresses per token seen up to each listed day."""
    return running_sum(new_addresses(first_seen, [TOKEN]), spine)


def running_total_by_token_day(
    first_seen: DataFrame, spine: DataFrame, prior: DataFrame, day: str | dt.date
) -> DataFrame:
    """Each token's latest total before ``day`` plus its new addresses since then.

    Covers the listed tokens and all that ``prior`` knows, so the chain of daily
    runs loses none. Of the first-seen table only token and day are read, and
    only counts of days are joined.
    """
    day = as_date(day)
    before = prior.where(between_days(prior, DATE, None, day - dt.timedelta(days=1)))
    latest = before.groupBy(TOKEN).agg(
        F.max_by("value_num", DATE).cast("bigint").alias("base"), F.max(DATE).alias("upto")
    )
    listed = scan(spine, on=day).select(TOKEN, F.lit(0).cast("bigint").alias("base"), F.lit(None).cast("date").alias("upto"))
    wanted = latest.unionByName(listed).groupBy(TOKEN).agg(F.max("base").alias("base"), F.max("upto").alias("upto"))
    counts = new_addresses(first_seen.where(between_days(first_seen, DATE, None, day)), [TOKEN])
    fresh = F.when(F.col("upto").isNull() | (F.col(DATE) > F.col("upto")), F.col("value_num"))
    return (
        wanted.join(counts, TOKEN, "left")
        .groupBy(TOKEN, "base")
        .agg(F.sum(fresh).alias("fresh"))
        .select((F.col("base") + F.coalesce("fresh", F.lit(0))).alias("value_num"), TOKEN, F.lit(day).alias(DATE))
    )
