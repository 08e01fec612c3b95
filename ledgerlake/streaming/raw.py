"""Raw log lines as a stream.

The batch load re-reads the last arrival days and replaces whole partitions.
The stream does the same step by step: each run picks up the files that are new
since the last one and works them in, once per document.

``append_available`` keeps a watermark and appends; what comes after the
watermark has passed it is lost to it. ``merge_available`` loses nothing: every
batch rewrites the date partitions it touches, and rows that come late, from the
future or without a time also go to a side table with the reason.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.functions.text import json_field
from ledgerlake.operators.parse import envelope
from ledgerlake.session import scratch_path
from ledgerlake.sources.sinks import write_partitions

DATE = "transaction_date"


def raw_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New files below ``path`` (a glob over the arrival folders) as lines."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).select(F.col("value").alias("info"))


def _hashed(lines: DataFrame) -> DataFrame:
    return envelope(lines.withColumn("block_hash", F.lower(json_field(F.col("info"), "$.hash"))), keep=("block_hash",))


def envelope_stream(lines: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Envelope rows, each block hash once within ``lateness`` of event time.

    State is one hash per block inside the watermark, spread over the shuffle
    partitions. Documents without a time cannot be placed and are left out.
    """
    return (
        _hashed(lines)
        .where(F.col("date_time").isNotNull())
        .withColumn("event_time", F.col("date_time").cast("timestamp"))
        .withWatermark("event_time", lateness)
        .dropDuplicatesWithinWatermark(["block_hash"])
        .drop("event_time", "block_hash")
    )


def append_available(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append all that is available to the partitioned source table, then stop (exactly once per checkpoint)."""
    return (
        stream.writeStream.format("parquet")
        .partitionBy("transaction_date")
        .option("checkpointLocation", checkpoint)
        .option("path", target)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def _table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException:
        return like.limit(0)


def merge_batch(batch: DataFrame, batch_id: int, target: str, side: str, lateness_days: int, ahead_days: int) -> None:
    """Work one batch into the table of envelope rows; doing it again changes nothing.

    The batch's documents are added to the date partitions they belong to, a
    document (its hash, or its text where it has none) once per partition, and
    only those partitions are rewritten. The new content is put together in the
    shared folder first: a partition is never read while it is replaced, and a
    run that dies between the two is repeated by the stream from its checkpoint.
    """
    spark = batch.sparkSession
    # "Late" is measured against the newest day of the table before this batch, leaving out days from the future.
    rows = batch.withColumn("document", F.coalesce("block_hash", F.md5(F.col("info")))).drop("block_hash")
    rows = rows.dropDuplicates([DATE, "document"])
    path = scratch_path(spark, f"stream-batch-{batch_id}")
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    stored = _table(spark, target, rows)
    today = F.current_date()
    newest = stored.where(F.col(DATE) <= F.date_add(today, ahead_days)).agg(F.max(DATE).alias("newest")).first().newest
    reason = F.when(F.col(DATE).isNull(), "undated").when(F.col(DATE) > F.date_add(today, ahead_days), "ahead")
    if newest is not None:
        reason = reason.when(F.col(DATE) < F.lit(newest - dt.timedelta(days=lateness_days)), "late")
    odd = rows.withColumn("reason", reason).where(F.col("reason").isNotNull()).withColumn("batch_id", F.lit(batch_id))
    write_partitions(odd, side, ["batch_id"])

    dated = rows.where(F.col(DATE).isNotNull())
    days = dated.select(DATE).distinct()
    touched = stored.join(days, DATE, "left_semi").select(dated.columns)
    merged = touched.unionByName(dated).dropDuplicates([DATE, "document"])
    path = scratch_path(spark, f"stream-merge-{batch_id}")
    merged.write.parquet(path)
    write_partitions(spark.read.schema(merged.schema).parquet(path), target, [DATE])


def merge_available(
    lines: DataFrame, target: str, side: str, checkpoint: str, lateness_days: int = 2, ahead_days: int = 1
) -> StreamingQuery:
    """Work all that is available into the date partitions of ``target``, then stop; no row is lost.

    ``side`` gets, per batch, the rows that came more than ``lateness_days``
    behind the newest day, lie more than ``ahead_days`` in the future, or have no
    time. The first two are in ``target`` as well, under their own dates; a block
    far ahead moves no limit, as days ahead do not count as newest.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, target, side, lateness_days, ahead_days)

    return (
        _hashed(lines)
        .writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
