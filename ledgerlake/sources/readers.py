"""Scans: partitioned tables, raw JSON lines, JDBC, CSV."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from ledgerlake.functions.dates import as_date, midnight, period_range


def table(spark: SparkSession, source: str) -> DataFrame:
    """A Parquet folder (anything with a slash) or a catalog table."""
    return spark.read.parquet(source) if "/" in source else spark.read.table(source)


def between_days(df: DataFrame, column: str, first: dt.date | None, last: dt.date | None) -> Column:
    """Rows dated ``first``..``last``, both included, on a date or a timestamp column.

    Written as a plain range on the column itself, so it prunes partitions and
    reaches the Parquet reader; either end may be open.
    """
    if isinstance(df.schema[column].dataType, DateType):
        low = None if first is None else F.col(column) >= F.lit(first)
        high = None if last is None else F.col(column) <= F.lit(last)
    else:
        low = None if first is None else F.col(column) >= midnight(first)
        high = None if last is None else F.col(column) < midnight(last + dt.timedelta(days=1))
    conditions = [c for c in (low, high) if c is not None]
    if not conditions:
        return F.lit(True)
    return conditions[0] if len(conditions) == 1 else conditions[0] & conditions[1]


def scan(
    df: DataFrame,
    on: str | dt.date | None = None,
    since: str | dt.date | None = None,
    month: str | None = None,
    column: str = "transaction_date",
) -> DataFrame:
    """One day (``on``), everything from a day (``since``), one month (``yyyy-MM``), or all."""
    if on is not None:
        first = last = as_date(on)
    elif month is not None:
        first, last = period_range(f"{month}-01", "month")
    else:
        first, last = (None if since is None else as_date(since)), None
    return df.where(between_days(df, column, first, last))


def read_raw(
    spark: SparkSession, root: str, day: str | dt.date, lookback: int = 2, files: str = "*.log"
) -> DataFrame:
    """Raw log lines that arrived on ``day`` or up to ``lookback`` days before.

    Below ``root`` lie ``local_date=.../<dir>/<dir>/*.log``. Only the wanted
    arrival folders are listed, in one scan; a day without a folder is no error.
    """
    day = as_date(day)
    days = ",".join((day - dt.timedelta(days=n)).isoformat() for n in range(lookback + 1))
    path = f"{root.rstrip('/')}/local_date={{{days}}}/*/*/{files}"
    return spark.read.text(path).select(F.col("value").alias("info"))


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **connection: str,
) -> dict[str, str]:
    """Reader options; user, password and driver come in ``connection``, never from code."""
    if (table is None) == (query is None):
        raise ValueError("give either table or query")
    options = {"url": url, "fetchsize": str(fetch_size), **connection}
    if partition_column is None:
        options["dbtable" if table else "query"] = table or query
        return options
    if lower is None or upper is None:
        raise ValueError("a partitioned read needs lower and upper")
    options["dbtable"] = table or f"({query}) q"
    options["partitionColumn"] = partition_column
    options["lowerBound"], options["upperBound"] = str(lower), str(upper)
    options["numPartitions"] = str(partitions)
    return options


def read_jdbc(spark: SparkSession, url: str, **options: object) -> DataFrame:
    """A table or query over JDBC; filters put on the result are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, **options)).load()


def read_csv_dim(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",") -> DataFrame:
    """A delimited dimension file, read with a given schema (no inference pass)."""
    return spark.read.schema(schema).option("sep", sep).option("mode", "PERMISSIVE").csv(path)
