"""Incremental load of files: a table of what was read already.

A file is known by its path and modification time. The listing is an anti-join
of the files that are there with the manifest, so a run reads new and rewritten
files only; the manifest is appended to after the load has succeeded, so a run
that fails is repeated in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE = "path string, modified timestamp, bytes long"


def listed(spark: SparkSession, root: str, pattern: str = "*.log") -> DataFrame:
    """path, modified and bytes of all files below ``root``; only the listing is read, no content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return files.load(root).select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def known(spark: SparkSession, manifest: str) -> DataFrame:
    """What the manifest holds; nothing before the first run."""
    try:
        return spark.read.schema(FILE).parquet(manifest)
    except AnalysisException:
        return spark.createDataFrame([], FILE)


def fresh(spark: SparkSession, root: str, manifest: str, pattern: str = "*.log") -> DataFrame:
    """Files that no run has read yet, or that were written again since."""
    return listed(spark, root, pattern).join(known(spark, manifest), ["path", "modified"], "left_anti")


def load_new_files(
    spark: SparkSession,
    root: str,
    manifest: str,
    load: Callable[[DataFrame], None],
    pattern: str = "*.log",
    files_per_read: int = 10_000,
) -> int:
    """Hand the lines of new files to ``load``, then note the files; returns how many files there were.

    ``load`` gets (info, file) and writes it, replacing what it wrote before for
    the same documents. Paths go to the reader in slices of a bounded number, in
    the order of their names; each slice is noted once it is loaded.
    """
    count = 0
    while True:
        new = fresh(spark, root, manifest, pattern).orderBy("path").limit(files_per_read).collect()  # names only, bounded
        if not new:
            return count
        lines = spark.read.text([r.path for r in new])
        load(lines.select(F.col("value").alias("info"), F.col("_metadata.file_path").alias("file")))
        spark.createDataFrame(new, FILE).coalesce(1).write.mode("append").parquet(manifest)
        count += len(new)
