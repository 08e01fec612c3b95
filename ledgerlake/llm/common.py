"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import ledgerlake
from ledgerlake.session import scratch_path, small_batches

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; pure ASCII texts take the fast built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a missing id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


# Folders written by ``staged`` in this process, in order.
_WRITTEN: list[str] = []


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and gives the planner a known size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def only_last(df: DataFrame, name: str, since: int) -> DataFrame:
    """``staged``, then what was staged since the mark ``since`` (see ``mark``) on the way to it is removed."""
    out = staged(df, name)
    context = df.sparkSession.sparkContext
    for path in _WRITTEN[since:-1]:
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
    _WRITTEN[since:-1] = []
    return out


def mark() -> int:
    return len(_WRITTEN)


# Bits of the filter that says which rows may meet a set of keys: 16 MB for any number of keys, without false negatives.
FILTER_BITS = 1 << 27


def flag_possible(rows: DataFrame, keys: DataFrame, columns: list[str], flag: str) -> DataFrame:
    """Adds ``flag``: false only where no row of ``keys`` has these values.

    The filter is a bitmap of at most FILTER_BITS bits, however many keys there are, so it can go to every task.
    """
    at = F.xxhash64(*columns).bitwiseAND(F.lit(FILTER_BITS - 1)) + 1
    sets = keys.groupBy(F.bitmap_bucket_number(at).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bits")
    )
    place = F.bitmap_bit_position("_at")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    joined = rows.withColumn("_at", at).join(F.broadcast(sets), F.bitmap_bucket_number("_at") == F.col("_bucket"), "left")
    hit = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    return joined.withColumn(flag, hit).drop("_at", "_bucket", "_bits")


def _same(columns: list[str]) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return same


def _renamed(keys: DataFrame, columns: list[str]) -> DataFrame:
    return keys.select(*[F.col(c).alias(f"_{c}") for c in columns])


def matching(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """The rows whose ``columns`` a row of ``keys`` (a table) holds; all but a few others stay out of the shuffle."""
    maybe = flag_possible(rows, keys, columns, "_maybe").filter("_maybe").drop("_maybe")
    return maybe.join(_renamed(keys, columns), _same(columns), "left_semi")


def settle(docs: DataFrame, id_col: str, text_col: str, gone: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` without those that ``gone`` names, and once only those that ``repeated`` names.

    Both are tables with id and mark, the hash of a row's text. Rows that neither names are not shuffled: only those
    that the filter cannot clear take part in the join. Of rows that repeat id and text the least by all columns stays.
    """
    columns, key = docs.columns, ["id", "mark"]
    rows = docs.select(
        F.struct(*columns).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_or_empty(text_col)).alias("mark")
    )
    named = gone.select(*key) if repeated is None else gone.select(*key).unionByName(repeated.select(*key))
    flagged = flag_possible(rows, named, key, "_maybe")
    clear = flagged.filter(~F.col("_maybe")).select("row")
    left = flagged.filter("_maybe").drop("_maybe").join(_renamed(gone, key), _same(key), "left_anti")
    left = left.select("row") if repeated is None else left.groupBy(*key).agg(F.min("row").alias("row")).select("row")
    return clear.unionByName(left).select(*[F.col("row").getField(c).alias(c) for c in columns])


# Applications that have the package on their executors.
_SHIPPED: set[str] = set()


def in_tasks(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, holds: bool = False
) -> DataFrame:
    """``df.mapInArrow``, with this package handed to the executors first: they need not have it installed.

    Rows come in batches of ``session.BATCH_ROWS``, so neither side holds much of a partition at a time. Workers serve one operator after another: unless the function ``holds`` a model, the last one's goes first.
    """
    small_batches(df.sparkSession)
    context = df.sparkSession.sparkContext
    if context.applicationId not in _SHIPPED:
        root = os.path.dirname(ledgerlake.__file__)
        path = os.path.join(tempfile.mkdtemp(prefix="ledgerlake-package-"), "ledgerlake.zip")
        with zipfile.ZipFile(path, "w") as package:
            for folder, _, names in os.walk(root):
                for name in sorted(n for n in names if n.endswith(".py")):
                    file = os.path.join(folder, name)
                    package.write(file, os.path.join("ledgerlake", os.path.relpath(file, root)))
        context.addPyFile(path)  # Spark serves it from the driver
        _SHIPPED.add(context.applicationId)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        yield from function(batches)

    return df.mapInArrow(function if holds else alone, schema)


# The model that a worker process holds, by name; a new one takes the place of the last, so memory is bounded by one.
_HELD: dict[object, object] = {}


def held(key: object, build: Callable[[], object]) -> object:
    """Inside a task: the model of this name, built once per worker process."""
    if key not in _HELD:
        let_go()
        _HELD[key] = build()
    return _HELD[key]


def let_go() -> None:
    """Inside a task: the worker's model goes, and free memory of Arrow and of the C library with it.

    Else a worker keeps what its models have needed in turn, beside an executor's heap that has long been filled.
    """
    _HELD.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def small_slices(batches: Iterator[pa.RecordBatch], rows: int = 512, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of at most so many rows and about so many bytes."""
    for batch in batches:
        per_row = max(1, batch.nbytes // max(1, batch.num_rows))
        step = max(1, min(rows, size // per_row))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
