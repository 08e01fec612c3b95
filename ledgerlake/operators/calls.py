"""Call trees of any depth, flattened to one row per call."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlake import schemas as S
from ledgerlake.functions.text import clean_lower
from ledgerlake.operators.parse import EVENT

_INDEX, _HASH = "calls_transaction_index", "calls_transaction_hash"
_NODE = (_INDEX, _HASH, "node_path", "parent_path", "calls_index")
_FLUSH_ROWS = 50_000


def _tree_walker(kept: list[str], fields: list[str]):
    """Arrow batches of call trees to Arrow batches of calls.

    Everything the tasks need is inside this function, so executors do not have
    to have the package installed.
    """
    names = [*kept, *_NODE, *fields]
    flush_rows = _FLUSH_ROWS
    plain = re.compile(r"[ \t\n\r]*(?:(true|false|null|-?[0-9][0-9.eE+-]*)|([\[\]{},:\"]))")
    read_string = json.decoder.scanstring

    def parse(text: str) -> object:
        """The JSON value; nesting deeper than the library's parser takes is read with an own stack."""
        try:
            return json.loads(text)
        except RecursionError:
            pass
        at, value, stack, key = 0, None, [], None
        while True:
            token = plain.match(text, at)
            if token is None:
                raise ValueError("not JSON")
            at, mark = token.end(), token[2]
            if mark in ("[", "{"):
                stack.append(([] if mark == "[" else {}, key))
                key = None
                continue
            if mark in (",", ":"):
                continue
            if mark in ("]", "}"):
                if not stack:
                    raise ValueError("not JSON")
                value, key = stack.pop()
            elif mark == '"':
                value, at = read_string(text, at)
                if stack and isinstance(stack[-1][0], dict) and key is None:
                    key = value
                    continue
            else:
                value = json.loads(token[1])
            if not stack:
                return value
            if isinstance(stack[-1][0], list):
                stack[-1][0].append(value)
            else:
                stack[-1][0][key] = value
            key = None

    def walk(siblings: object) -> Iterator[tuple[str, str, str, dict]]:
        """(path, parent path, sibling index, node); a root is its own parent."""
        stack = [("", siblings)]
        while stack:
            parent, siblings = stack.pop()
            if not isinstance(siblings, list):
                continue
            for index, node in enumerate(siblings):
                node = node if isinstance(node, dict) else {}
                path = f"{parent}/{index}" if parent else str(index)
                yield path, parent or path, str(index), node
                if node.get("calls"):
                    stack.append((path, node["calls"]))

    def trees(index: str | None, tx_hash: str | None, tree: str | None, document: str | None):
        """(index, hash, parsed tree): the one given, or those of a whole document."""
        try:
            parsed = parse(tree if document is None else document)
        except ValueError:  # not JSON at all: no parser gets rows from it
            return
        if document is None:
            yield index, tx_hash, parsed
            return
        for tx in part(parsed, "transactions", list):
            base, trace = part(tx, "base", dict), part(tx, "trace", dict)
            yield text(base.get("transactionIndex")), text(base.get("hash")), trace.get("calls")

    def part(holder: object, name: str, kind: type):
        """A part of the right type; an empty one where it is missing or something else."""
        found = holder.get(name) if isinstance(holder, dict) else None
        return found if isinstance(found, kind) else kind()

    def text(value: object) -> str | None:
        if value is None or isinstance(value, str):
            return value
        try:
            return json.dumps(value)
        except RecursionError:  # a tree where a field should be
            return None

    def emit(batch: pa.RecordBatch, origin: list[int], rows: list[tuple]) -> pa.RecordBatch:
        picked = pa.array(origin, pa.int64())
        arrays = [batch.column(name).take(picked) for name in kept]
        arrays += [pa.array(column, pa.string()) for column in zip(*rows)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def nodes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            origin: list[int] = []
            rows: list[tuple] = []
            inputs = [batch.column(name) for name in ("index", "hash", "tree", "document")]
            for row in range(batch.num_rows):  # one tree at a time becomes Python objects
                for index, tx_hash, tree in trees(*(column[row].as_py() for column in inputs)):
                    for path, parent, sibling, node in walk(tree):
                        origin.append(row)
                        values = [text(node.get(field)) for field in fields]
                        rows.append((index, tx_hash, path, parent, sibling, *values))
                        if len(rows) >= flush_rows:
                            yield emit(batch, origin, rows)
                            origin, rows = [], []
            if rows:
                yield emit(batch, origin, rows)

    return nodes


# What of a document is parsed for its call trees; ``unread`` holds a document that the JSON reader gave up on.
TREES = (
    S.transactions_of(base=S.texts(["transactionIndex", "hash"]), trace=S.texts(["calls"])).add("unread", StringType()),
    {**S.JSON_OPTIONS, "columnNameOfCorruptRecord": "unread"},
)


def call_trees(block: Column) -> Column:
    """The call trees of a parsed document as (index, hash, tree, document): the tree's text, or the whole document."""
    item = "struct<index: string, hash: string, tree: string, document: string>"
    nothing = F.lit(None).cast("string")
    usual = F.transform(
        block["transactions"],
        lambda tx: F.struct(tx["base"]["transactionIndex"], tx["base"]["hash"], tx["trace"]["calls"], nothing).cast(item),
    )
    whole = F.array(F.struct(nothing, nothing, nothing, block["unread"]).cast(item))
    return F.when(block["unread"].isNotNull(), whole).otherwise(usual)


def flatten_calls(source: DataFrame) -> DataFrame:
    """Every internal call below every transaction's trace, from the envelope table or the nested one.

    The level of nesting is open, so the tree text is walked in one Arrow pass
    inside the tasks (an explicit stack); parsing the block, cleaning and typing
    stay JVM expressions. A block whose tree is too deep for the JSON writer to
    hand over as text goes to the tasks as a whole document instead.
    ``calls_id`` is the transaction hash plus the node's path, so a retried task
    gives the same ids; a root's parent is itself.
    """
    if "trees" in source.columns:
        items = source.select(*EVENT, F.inline("trees"))
    else:
        parsed = source.select(*EVENT, F.from_json("info", *TREES).alias("block"))
        items = parsed.select(*EVENT, F.inline(call_trees(F.col("block"))))
    trees = items.where(F.col("tree").isNotNull() | F.col("document").isNotNull())
    kept, fields = list(EVENT), list(S.CALL_FIELDS)
    out = StructType(
        [trees.schema[name] for name in kept] + [StructField(name, StringType()) for name in (*_NODE, *fields)]
    )
    flat = trees.mapInArrow(_tree_walker(kept, fields), out)
    tx = clean_lower(F.col(_HASH))
    return flat.select(
        F.concat(tx, F.lit("/"), "node_path").alias("calls_id"),
        F.concat(tx, F.lit("/"), "parent_path").alias("calls_parent_id"),
        "calls_index",
        *[clean_lower(F.col(f"`{field}`")).alias(column) for field, column in S.CALL_FIELDS.items()],
        "block_number",
        clean_lower(F.col(_INDEX)).alias(_INDEX),
        tx.alias(_HASH),
        "dh",
        "date_time",
        "transaction_date",
    )


def quarantine(source: DataFrame) -> DataFrame:
    """Documents that some parser gets less from than they hold, with the reason: kept apart, to be counted and mended.

    ``no object``: not a JSON object; ``transactions``: not a list; ``undated``:
    no readable time, so no dated run meets the document.
    """
    listed = F.ltrim(F.get_json_object("info", "$.transactions"))
    reason = (
        F.when(F.col("info").isNull() | ~F.col("info").rlike(r"^\s*\{"), "no object")
        .when(listed.isNotNull() & ~listed.startswith("["), "transactions")
        .when(F.col("date_time").isNull(), "undated")
    )
    return source.select("info", *EVENT, reason.alias("reason")).where(F.col("reason").isNotNull())


def exclude_senders(calls: DataFrame, senders: list[str], column: str = "calls_from") -> DataFrame:
    """Drop calls of listed senders (a short configured list)."""
    return calls.where(~F.col(column).isin([s.lower() for s in senders])) if senders else calls
