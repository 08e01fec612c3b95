"""Dormant and awakened senders per token.

A sender is dormant on a day when it has sent before and its last send lies
more than ``idle`` days back; it awakes on the day it sends again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.dates import as_date
from ledgerlake.operators.metrics import DATE, TOKEN
from ledgerlake.operators.spine import fill
from ledgerlake.operators.totals import running_sum
from ledgerlake.sources.readers import between_days, scan

IDLE_DAYS = 60


def _on_spine(counts: DataFrame, spine: DataFrame, day: dt.date) -> DataFrame:
    listed = scan(spine, on=day).select(TOKEN, DATE)
    return fill(listed, counts, [TOKEN]).select("value_num", TOKEN, DATE)


def dormant(
    first_sent: DataFrame,
    transfers: DataFrame,
    spine: DataFrame,
    day: str | dt.date,
    idle: int = IDLE_DAYS,
    sender: str = "from_address",
) -> DataFrame:
    """Senders first seen up to ``day`` that sent nothing in the ``idle`` days before it or on it.

    ``first_sent`` is the first-seen table of senders. Only the window's
    partitions of the transfers are read, cut to one row per sender before the
    join.
    """
    day = as_date(day)
    keys = ["customer_address", TOKEN]
    seen = first_sent.where(between_days(first_sent, DATE, None, day)).select(*keys)
    recent = (
        transfers.where(between_days(transfers, DATE, day - dt.timedelta(days=idle), day))
        .select(F.col(sender).alias("customer_address"), TOKEN)
        .distinct()
    )
    counts = seen.join(recent, keys, "left_anti").groupBy(TOKEN).agg(F.count("*").alias("value_num"))
    return _on_spine(counts, spine, day)


def awakened(
    first_sent: DataFrame,
    transfers: DataFrame,
    spine: DataFrame,
    day: str | dt.date,
    idle: int = IDLE_DAYS,
    sender: str = "from_address",
) -> DataFrame:
    """Senders that were dormant the day before and send on ``day``.

    One scan of the window tells both who sent on the day and who sent shortly
    before.
    """
    day = as_date(day)
    before = day - dt.timedelta(days=1)
    keys = ["customer_address", TOKEN]
    woken = (
        transfers.where(between_days(transfers, DATE, day - dt.timedelta(days=idle + 1), day))
        .groupBy(F.col(sender).alias("customer_address"), TOKEN)
        .agg(F.min(DATE).alias("earliest"))
        .where(F.col("earliest") == F.lit(day))
        .select(*keys)
    )
    seen = first_sent.where(between_days(first_sent, DATE, None, before)).select(*keys)
    counts = seen.join(woken, keys, "left_semi").groupBy(TOKEN).agg(F.count("*").alias("value_num"))
    return _on_spine(counts, spine, day)


def awakened_history(
    transfers: DataFrame, spine: DataFrame, idle: int = IDLE_DAYS, sender: str = "from_address"
) -> DataFrame:
    """Awakened senders on every listed day, from the gaps between active days.

    The window sees one row per sender, token and active day.
    """
    keys = ["customer_address", TOKEN]
    active = transfers.select(F.col(sender).alias("customer_address"), TOKEN, DATE).distinct()
    gap = F.date_diff(F.col(DATE), F.lag(DATE).over(Window.partitionBy(*keys).orderBy(DATE)))
    counts = (
        active.withColumn("gap", gap)
        .where(F.col("gap") >= idle + 2)
        .groupBy(TOKEN, DATE)
        .agg(F.count("*").alias("value_num"))
    )
    return fill(spine.select(TOKEN, DATE), counts, [TOKEN, DATE]).select("value_num", TOKEN, DATE)


def dormant_history(
    transfers: DataFrame, spine: DataFrame, idle: int = IDLE_DAYS, sender: str = "from_address"
) -> DataFrame:
    """Dormant senders on every listed day, by a sweep over the days on which senders fall asleep and wake.

    A sender falls asleep ``idle + 1`` days after a send that no other follows by
    then, and wakes with its next one. One scan; what the running sum sees are a
    token's days with a change, and its listed days.
    """
    keys = ["customer_address", TOKEN]
    active = transfers.select(F.col(sender).alias("customer_address"), TOKEN, DATE).distinct()
    following = F.lead(DATE).over(Window.partitionBy(*keys).orderBy(DATE))
    asleep = F.date_add(DATE, idle + 1)
    changes = (
        active.select(TOKEN, asleep.alias("asleep"), following.alias("awake"))
        .where(F.col("awake").isNull() | (F.col("awake") > F.col("asleep")))
        .select(
            TOKEN,
            F.inline(
                F.array(
                    F.struct(F.col("asleep").alias(DATE), F.lit(1).cast("bigint").alias("change")),
                    F.struct(F.col("awake").alias(DATE), F.lit(-1).cast("bigint").alias("change")),
                )
            ),
        )
        .where(F.col(DATE).isNotNull())
    )
    return running_sum(changes, spine, "change")
