"""Date column expressions.

Times are ``timestamp_ntz`` holding UTC, so no result depends on the time zone
of the session.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month")


def epoch_to_ts(seconds: Column) -> Column:
    """Epoch seconds as UTC time; text that is not a whole number gives null."""
    return F.timestamp_add("SECOND", seconds.try_cast("bigint"), midnight(dt.date(1970, 1, 1)))


def midnight(day: dt.date) -> Column:
    """Start of a day; made from text, because a datetime literal would be read in the session's time zone."""
    return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")


def hour_key(ts: Column) -> Column:
    """Hour of day as two characters."""
    return F.lpad(F.hour(ts).cast("string"), 2, "0")


def date_parts(ts: Column) -> dict[str, Column]:
    """Year, month and day as text, the date, and the hour key."""
    return {
        "year": F.lpad(F.year(ts).cast("string"), 4, "0"),
        "month": F.lpad(F.month(ts).cast("string"), 2, "0"),
        "day": F.lpad(F.day(ts).cast("string"), 2, "0"),
        "date": F.to_date(ts),
        "hour": hour_key(ts),
    }


def hour_stamp(date: Column, hour: Column) -> Column:
    """``yyyy-MM-dd HH:00:00``"""
    return F.concat(date.cast("string"), F.lit(" "), hour, F.lit(":00:00"))


def shift_days(date: Column, days: int) -> Column:
    return F.date_add(date, days)


def week_monday(date: Column) -> Column:
    return F.trunc(date, "week")


def week_sunday(date: Column) -> Column:
    return F.date_add(F.trunc(date, "week"), 6)


def month_first(date: Column) -> Column:
    return F.trunc(date, "month")


def month_last(date: Column) -> Column:
    return F.last_day(date)


def period(date: Column, grain: str) -> Column:
    """The key of the period a date falls in: the day, its Monday, or the first of its month."""
    if grain == "day":
        return date
    if grain == "week":
        return week_monday(date)
    if grain == "month":
        return month_first(date)
    raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")


def as_date(day: str | dt.date) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


def period_range(day: str | dt.date, grain: str) -> tuple[dt.date, dt.date]:
    """First and last date an incremental run for ``day`` has to read.

    A week run covers Monday up to the day, a month run the whole month.
    """
    day = as_date(day)
    if grain == "day":
        return day, day
    if grain == "week":
        return day - dt.timedelta(days=day.weekday()), day
    if grain == "month":
        following = (day.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        return day.replace(day=1), following - dt.timedelta(days=1)
    raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")
