"""Raw block documents to flat tables.

Every parser takes the envelope table (``info`` holds one block document), or the
nested table that ``documents.parse_documents`` made of it, and works row by row:
no shuffle, one pass. From the nested table a parser reads its own columns only.
Rows carry the block's ``dh``, ``date_time`` and ``transaction_date``; drop ``dh``
for a backfill table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ledgerlake import schemas as S
from ledgerlake.functions.dates import epoch_to_ts, hour_key
from ledgerlake.functions.numbers import to_bigint
from ledgerlake.functions.text import clean, clean_lower

TIMES = ("dh", "date_time", "transaction_date")
EVENT = ("block_number", *TIMES)
# Partitions of documents that were imported folder by folder.
IMPORT_KEYS = ("dir", "transaction_date")


def envelope(df: DataFrame, info: str = "info", keep: tuple[str, ...] = ()) -> DataFrame:
    """Block number and UTC time of each document; other columns named in ``keep`` pass through.

    A missing or non-numeric timestamp gives null times. An import table keyed by
    its arrival folder keeps ``dir`` and is written by ``dir`` and date
    (``sinks.write_partitions(df, path, IMPORT_KEYS)``).
    """
    header = F.from_json(info, S.texts(["number", "timestamp"]), S.JSON_OPTIONS)
    return (
        df.withColumn("_header", header)
        .withColumn("date_time", epoch_to_ts(clean(F.col("_header.timestamp"))))
        .select(
            F.col(info).alias("info"),
            to_bigint(F.col("_header.number")).alias("block_number"),
            hour_key(F.col("date_time")).alias("dh"),
            "date_time",
            *keep,
            F.to_date("date_time").alias("transaction_date"),
        )
    )


def _fields(parent: str, fields: Mapping[str, str]) -> list[Column]:
    return [clean_lower(F.col(f"{parent}.{field}")).alias(column) for field, column in fields.items()]


NESTED = "block"


def _header(source: DataFrame, shape: StructType) -> Column:
    """The parsed document; fields beyond ``shape`` may be there and cost nothing unless named."""
    return F.col(NESTED) if NESTED in source.columns else F.from_json("info", shape, S.JSON_OPTIONS)


def _each_transaction(source: DataFrame, shape: StructType) -> DataFrame:
    """One row per transaction; blocks without transactions give none."""
    if NESTED in source.columns:
        # Each field as a list of its own, so that the scan reads the wanted ones only.
        parts = shape["transactions"].dataType.elementType
        paths = {f"{part.name}_{field.name}": (part.name, field.name) for part in parts for field in part.dataType}
        lists = source.select(*EVENT, *[F.col(f"{NESTED}.transactions.{p}.{f}").alias(name) for name, (p, f) in paths.items()])
        rows = lists.select(*EVENT, F.explode(F.arrays_zip(*paths)).alias("at"))
        rebuilt = [
            F.struct(*[F.col(f"at.{name}").alias(f) for name, (p, f) in paths.items() if p == part.name]).alias(part.name)
            for part in parts
        ]
        return rows.select(*EVENT, F.struct(*rebuilt).alias("tx"))
    parsed = F.from_json("info", shape, S.JSON_OPTIONS).getField("transactions")
    return source.select(*EVENT, F.explode(parsed).alias("tx"))


def parse_blocks(source: DataFrame) -> DataFrame:
    header = _header(source, S.texts(S.BLOCK_FIELDS))
    return source.select(*EVENT, header.alias("block")).select(
        *_fields("block", S.BLOCK_FIELDS), "block_number", *TIMES
    )


def parse_transactions(source: DataFrame) -> DataFrame:
    """Transactions; gas used comes from the receipt."""
    shape = S.transactions_of(base=S.texts(S.BASE_FIELDS), receipt=S.texts(["gasUsed"]))
    return _each_transaction(source, shape).select(
        *_fields("tx.base", S.BASE_FIELDS),
        clean_lower(F.col("tx.receipt.gasUsed")).alias("base_gas_used"),
        "block_number",
        *TIMES,
    )


def receipt_status(status: Column) -> Column:
    """``false`` for 0x0 and false, empty when absent, ``true`` otherwise."""
    text = clean_lower(status)
    return F.when(text == "", "").when(text.isin("0x0", "false"), "false").otherwise("true")


def parse_receipts(source: DataFrame) -> DataFrame:
    """Receipts; the block number is the receipt's own."""
    shape = S.transactions_of(receipt=S.texts([*S.RECEIPT_FIELDS, "blockNumber", "status"]))
    return _each_transaction(source, shape).select(
        *_fields("tx.receipt", S.RECEIPT_FIELDS),
        receipt_status(F.col("tx.receipt.status")).alias("receipt_status"),
        to_bigint(F.col("tx.receipt.blockNumber")).alias("block_number"),
        *TIMES,
    )


def parse_logs(source: DataFrame) -> DataFrame:
    """Log events of all receipts; topics as lower-case JSON text plus the first topic."""
    shape = S.transactions_of(receipt=S.doc(logs=ArrayType(S.log())))
    topics = F.transform("log.topics", lambda t: F.lower(t))
    some = F.size("log.topics") > 0
    return (
        _each_transaction(source, shape)
        .select(*TIMES, F.explode("tx.receipt.logs").alias("log"))
        .select(
            *_fields("log", S.LOG_FIELDS),
            F.when(some, F.to_json(topics)).otherwise("").alias("logs_topics"),
            F.when(some, F.coalesce(F.try_element_at(topics, F.lit(1)), F.lit(""))).otherwise("").alias(
                "logs_topics_one"
            ),
            to_bigint(F.col("log.blockNumber")).alias("block_number"),
            *TIMES,
        )
    )


def parse_traces(source: DataFrame) -> DataFrame:
    """The top-level trace of each transaction; index and hash come from the base part."""
    shape = S.transactions_of(base=S.texts(["transactionIndex", "hash"]), trace=S.texts(S.TRACE_FIELDS))
    return _each_transaction(source, shape).select(
        *_fields("tx.trace", S.TRACE_FIELDS),
        "block_number",
        clean_lower(F.col("tx.base.transactionIndex")).alias("trace_transaction_index"),
        clean_lower(F.col("tx.base.hash")).alias("trace_transaction_hash"),
        *TIMES,
    )


def parse_uncles(source: DataFrame) -> DataFrame:
    """Uncles with a hash; their own time is UTC."""
    shape = S.doc(uncles=ArrayType(S.texts([*S.UNCLE_FIELDS, "time"])))
    return (
        source.select(*EVENT, F.explode(_header(source, shape).getField("uncles")).alias("uncle"))
        .select(
            "block_number",
            *_fields("uncle", S.UNCLE_FIELDS),
            epoch_to_ts(clean(F.col("uncle.time"))).alias("uncles_time"),
            *TIMES,
        )
        .where(F.col("uncles_hash") != "")
    )
