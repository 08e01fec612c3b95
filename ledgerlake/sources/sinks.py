"""Parquet and catalog sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitions(
    df: DataFrame, path: str, by: Sequence[str] = ("transaction_date",), max_records: int = 20_000_000
) -> None:
    """Write Parquet, replacing only the partitions the frame has rows for.

    Rows of one partition are gathered so that a date does not end in a small
    file per task; the rebalance hint lets adaptive execution merge small
    partitions and split one that is too big, so a hot date is written by many
    tasks. A partition for which the frame has no row is left as it is.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records)
        .partitionBy(*by)
        .parquet(path)
    )


def write_table(df: DataFrame, target: str, mode: str = "overwrite", by: Sequence[str] = ()) -> None:
    """Overwrite or append a whole table (Parquet folder or catalog table), columns by name."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode!r}")
    writer = df.write.mode(mode)
    if by:
        writer = writer.partitionBy(*by)
    if "/" in target:
        writer.parquet(target)
    elif df.sparkSession.catalog.tableExists(target):
        # Into the existing table by position, so put the columns in its order.
        columns = df.sparkSession.read.table(target).columns
        df.select(*columns).write.insertInto(target, overwrite=mode == "overwrite")
    else:
        writer.format("parquet").saveAsTable(target)


def partition_listing(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct partition tuples of a partitioned table."""
    return df.select(*by).distinct()


def register_partitions(spark: SparkSession, table: str) -> None:
    """Make partition folders written past the catalog visible; running it again changes nothing."""
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
