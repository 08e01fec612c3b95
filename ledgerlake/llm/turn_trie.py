"""Prefix trie of conversations, from padded matrices of turn ids.

Every turn gets a 128-bit id from its role and text; a conversation is the string
of its ids. Conversations are range-partitioned by that string (then by id), so a
shard is a stretch of the trie's depth-first order, whichever prefix is frequent,
and copies of one conversation are spread as well. A shard numbers its turns,
pads them to matrices of ``WIDTH`` columns, sorts the rows with numpy's lexsort,
and OR-accumulates along the rows where a column differs from the row above: the
marks in a column are the nodes of its depth, and reduceat adds up each of them.
Subtree sums are taken from the deepest column upwards, placed at a node's first
row.

Only nodes on the path of a shard's first or last row can go on in another shard.
Those stay open: the shard hands on what their closed children add up to, and
``FAN_IN`` neighbouring shards at a time are merged until nothing is open. Ids of
conversations that end at an open node travel in bounded chunks, and one stream
per node hashes them in order.

Defined results: a null role or text counts as empty; turns without a number come
first, turns of one number are ordered by their ids (any fixed order); repeated
rows are turns of their own; rows without a conversation's id belong to none and
are left out; a conversation without turns ends at the root; an empty table gives
no rows. Conversation ids are integers. Other columns are not read. A task holds
the turn ids of its shard (24 bytes a turn) and, per level of its longest
conversation, a few small arrays; texts never leave the scan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import in_tasks, staged, text_or_empty

WIDTH = 16  # columns of a matrix
SHARD_TURNS = 1_000_000
FAN_IN = 16
CHUNK = 1 << 16  # ids of ended conversations in a row
FAMILY, MODULUS = 5, 9  # conversations that share a start, and the longest start (excluded)

PARTS = [
    ("kind", pa.string()),  # node, open or ends
    ("unit", pa.int64()),
    ("key", pa.binary()),  # of a node that is or was open
    ("parent_key", pa.binary()),  # of a parent that is still open
    ("conv_id", pa.int64()),
    ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()),
    ("n_children", pa.int64()),
    ("n_leaves", pa.int64()),
    ("saved", pa.int64()),
    ("bytes", pa.int64()),
    ("left", pa.bool_()),
    ("right", pa.bool_()),
    ("payload", pa.binary()),  # digest of ended conversations, or their ids
]
_DDL = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary", pa.bool_(): "boolean"}
SCHEMA = pa.schema(PARTS)
SCHEMA_DDL = ", ".join(f"{name} {_DDL[kind]}" for name, kind in PARTS)
ROOT = bytes(16)


# --- conversations ---


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, ids (16 bytes a turn) and sizes (bytes of the texts) of every rebuilt conversation."""
    role, text = text_or_empty("role"), text_or_empty("text")
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        "turn",
        F.unhex(F.substring(F.sha2(named.cast("binary"), 256), 1, 32)).alias("id"),
        F.octet_length(text).cast("long").alias("size"),
    )
    conv = F.col("conv_id").cast("long")
    rows = turns.filter("conv_id IS NOT NULL").select((conv - conv % FAMILY).alias("base"), conv.alias("conv_id"), turn.alias("turn"))
    # One shuffle: a family of conversations meets in a task.
    own = rows.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("own"))
    first = F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, MODULUS - 1))
    own = own.withColumn("head", F.max(first).over(Window.partitionBy("base")))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MODULUS).cast("int")
    nothing = F.slice("own", 1, 0)
    kept: Column = F.concat(F.coalesce(F.slice("head", F.lit(1), h), nothing), F.slice("own", h + 1, F.size("own")))
    return own.select("conv_id", kept.alias("turns")).select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")).alias("ids"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"),
    )


# --- a shard ---


def _numbered(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Dense numbers from 1, in the order of the ids."""
    order = np.lexsort((low, high))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (high[order[1:]] != high[order[:-1]]) | (low[order[1:]] != low[order[:-1]])
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new)
    return number


def _matrix(number: np.ndarray, begin: np.ndarray, length: np.ndarray, start: int) -> np.ndarray:
    """Columns start .. start + WIDTH of the given rows; 0 where a row has ended."""
    at = start + np.arange(WIDTH)
    inside = at < length[:, None]
    if not len(number):
        return np.zeros(inside.shape, dtype=np.int64)
    return np.where(inside, number[np.minimum(begin[:, None] + at, len(number) - 1)], 0)


def _sorted_rows(number: np.ndarray, begin: np.ndarray, length: np.ndarray, conv: np.ndarray) -> np.ndarray:
    """Rows by their turns, an ended row before longer ones, copies by conversation."""
    rank = np.zeros(len(conv), dtype=np.int64)  # place of the first row of a class of equal starts
    rows = np.arange(len(conv))
    start = 0
    while len(rows):
        matrix = _matrix(number, begin[rows], length[rows], start)
        start += WIDTH
        more = length[rows] > start
        order = np.lexsort((more, *matrix.T[::-1], rank[rows]))
        rows, matrix, more = rows[order], matrix[order], more[order]
        place = np.arange(len(rows))
        old = np.ones(len(rows), dtype=bool)
        old[1:] = rank[rows[1:]] != rank[rows[:-1]]
        new = old.copy()
        new[1:] |= (matrix[1:] != matrix[:-1]).any(axis=1) | (more[1:] != more[:-1])
        first = np.flatnonzero(new)
        rank[rows] += np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(old, place, 0))
        crowd = np.repeat(np.diff(np.append(first, len(rows))) > 1, np.diff(np.append(first, len(rows))))
        rows = rows[more & crowd]
    return np.lexsort((conv, rank))


def _digest(convs: np.ndarray) -> bytes:
    return hashlib.sha256(",".join(map(str, convs.tolist())).encode()).digest()


def _step(key: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(key + turn, digest_size=16).digest()


class _Level:
    """The nodes of one depth: their stretch of the block's rows, first row, and what is known on the way down."""

    def __init__(self, block: int, column: int, marks: np.ndarray, matrix: np.ndarray, rows: np.ndarray, conv: np.ndarray):
        self.block, self.column = block, column
        self.all_starts = np.flatnonzero(marks)
        self.keep = matrix[self.all_starts] != 0
        ends = np.append(self.all_starts[1:], len(rows))
        self.start = self.all_starts[self.keep]
        self.first = rows[self.start]
        self.count = (ends - self.all_starts)[self.keep]
        self.least = np.minimum.reduceat(conv[rows], self.all_starts)[self.keep]
        self.left = self.first == 0
        self.right = rows[ends[self.keep] - 1] == len(conv) - 1

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.all_starts)[self.keep]


def shard(unit: int, conv: np.ndarray, length: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> Iterator[dict[str, object]]:
    """Columns of closed nodes level by level, then of open ones and of the ids that end there.

    ``ids`` holds two big-endian numbers a turn, of all rows one after another.
    """
    pairs = ids.reshape(-1, 2)
    number = _numbered(pairs[:, 0], pairs[:, 1])
    begin = np.cumsum(length) - length
    order = _sorted_rows(number, begin, length, conv)
    conv, length, begin = conv[order], length[order], begin[order]
    n = len(conv)

    # Downwards: nodes of each depth. Depth 0 is a column of ones.
    whole = np.arange(n)
    blocks: list[tuple[np.ndarray, np.ndarray]] = [(whole, np.ones((n, 1), dtype=np.int64))]
    levels = [_Level(0, 0, whole == 0, blocks[0][1][:, 0], whole, conv)]
    rows = whole[length > 0]
    while len(rows):
        start = len(levels) - 1
        matrix = _matrix(number, begin[rows], length[rows], start)
        above = np.searchsorted(levels[-1].first, rows, side="right")
        marks = np.ones(matrix.shape, dtype=bool)
        marks[1:] = matrix[1:] != matrix[:-1]
        marks[1:, 0] |= above[1:] != above[:-1]
        marks = np.logical_or.accumulate(marks, axis=1)
        blocks.append((rows, matrix))
        for j in range(WIDTH):
            if not matrix[:, j].any():
                break
            levels.append(_Level(len(blocks) - 1, j, marks[:, j], matrix[:, j], rows, conv))
        rows = rows[length[rows] > start + WIDTH]

    def path(row: int) -> list[bytes]:
        keys = [ROOT]
        for k in range(begin[row], begin[row] + length[row]):
            keys.append(_step(keys[-1], pairs[k].tobytes()))
        return keys

    left_path, right_path = path(0), path(n - 1)

    # Upwards: what the children of a node add up to stands at the node's first row.
    leaves, saved, children = (np.zeros(n, dtype=np.int64) for _ in range(3))
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        rows, matrix = blocks[level.block]
        sums = [level.sums(x[rows]) for x in (leaves, saved, children)]
        size = sizes[begin[level.first] + depth - 1] if depth else np.zeros(1, dtype=np.int64)
        ended = level.sums((length[rows] == depth).astype(np.int64))
        is_open = level.left | level.right
        closed = ~is_open
        own_leaves = np.where(sums[2] == 0, 1, sums[0])
        own_saved = sums[1] + (level.count - 1) * size
        inside = rows[matrix[:, level.column] != 0]
        for x, own in ((leaves, own_leaves), (saved, own_saved), (children, 1)):
            x[inside] = 0
            x[level.first] = np.where(closed, own, 0)
        if depth:
            up = levels[depth - 1]
            parent = np.searchsorted(up.first, level.first, side="right") - 1
            parent_open = (up.left | up.right)[parent]
            parent_least = up.least[parent]
        if closed.any():
            at = np.flatnonzero(closed)
            open_parent = parent_open[at]
            left_parent = up.left[parent[at]]
            yield {
                "kind": ["node"] * len(at),
                "conv_id": level.least[at],
                "depth": np.full(len(at), depth),
                "parent_conv_id": pa.array(parent_least[at], mask=open_parent),
                "parent_key": [
                    (left_path if lp else right_path)[depth - 1] if o else None
                    for o, lp in zip(open_parent.tolist(), left_parent.tolist())
                ],
                "n_convs": level.count[at],
                "n_children": sums[2][at],
                "n_leaves": own_leaves[at],
                "saved": own_saved[at],
                "payload": [
                    _digest(conv[f : f + k]) if k else None for f, k in zip(level.first[at].tolist(), ended[at].tolist())
                ],
            }
        for k in np.flatnonzero(is_open).tolist():
            keys = left_path if level.left[k] else right_path
            yield {
                "kind": ["open"],
                "unit": [unit],
                "key": [keys[depth]],
                "parent_key": [keys[depth - 1] if depth else None],
                "conv_id": [int(level.least[k])],
                "depth": [depth],
                "n_convs": [int(level.count[k])],
                "n_children": [int(sums[2][k])],
                "n_leaves": [int(sums[0][k])],
                "saved": [int(sums[1][k])],
                "bytes": [int(size[k])],
                "left": [bool(level.left[k])],
                "right": [bool(level.right[k])],
            }
            first, last = int(level.first[k]), int(level.first[k] + ended[k])
            for c in range(first, last, CHUNK):
                some = conv[c : min(last, c + CHUNK)]
                yield {
                    "kind": ["ends"],
                    "unit": [unit],
                    "key": [keys[depth]],
                    "conv_id": some[:1],
                    "payload": [",".join(map(str, some.tolist())).encode()],
                }


def _batches(parts: Iterator[dict[str, object]], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of some tens of thousand rows; columns that a part lacks are null."""

    def column(part: dict[str, object], name: str, kind: pa.DataType) -> pa.Array:
        values = part.get(name)
        if values is None:
            return pa.nulls(len(part["kind"]), kind)
        return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)

    held, n = [], 0
    for part in parts:
        held.append(pa.RecordBatch.from_arrays([column(part, name, kind) for name, kind in PARTS], schema=SCHEMA))
        n += held[-1].num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    convs, lengths, ids, sizes = [], [], [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.column(1)
        at = np.frombuffer(names.buffers()[1], dtype=np.int32)[names.offset : names.offset + len(names) + 1]
        raw = names.buffers()[2]
        convs.append(np.array(batch.column(0)))
        lengths.append(np.diff(at).astype(np.int64) // 16)
        ids.append(np.frombuffer(raw, dtype=np.uint8)[at[0] : at[-1]].copy() if raw is not None else np.zeros(0, dtype=np.uint8))
        sizes.append(np.array(batch.column(2).flatten()).astype(np.int64))
    if convs:
        unit = TaskContext.get().partitionId()
        pairs = np.concatenate(ids).view(">u8")
        yield from _batches(shard(unit, np.concatenate(convs), np.concatenate(lengths), pairs, np.concatenate(sizes)))


# --- boundary nodes ---


def merge(unit: int, opens: list[dict], final: bool) -> Iterator[dict[str, object]]:
    """Open nodes of neighbouring units put together; those that are no longer on an outer path are closed."""
    first, last = min(x["unit"] for x in opens), max(x["unit"] for x in opens)
    nodes: dict[bytes, dict] = {}
    for x in opens:
        x["left"] &= x["unit"] == first and not final
        x["right"] &= x["unit"] == last and not final
        known = nodes.setdefault(x["key"], x)
        if known is not x:
            known["conv_id"] = min(known["conv_id"], x["conv_id"])
            for name in ("n_convs", "n_children", "n_leaves", "saved"):
                known[name] += x[name]
            for name in ("left", "right"):
                known[name] |= x[name]
    for x in sorted(nodes.values(), key=lambda x: -x["depth"]):
        parent = nodes.get(x["parent_key"])
        row = {name: [x[name]] for name in ("key", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved")}
        if x["left"] or x["right"]:
            yield row | {name: [x[name]] for name in ("parent_key", "bytes", "left", "right")} | {"kind": ["open"], "unit": [unit]}
            continue
        leaves = x["n_leaves"] if x["n_children"] else 1
        saved = x["saved"] + (x["n_convs"] - 1) * x["bytes"]
        if parent:
            parent["n_children"] += 1
            parent["n_leaves"] += leaves
            parent["saved"] += saved
        known = parent is not None and not (parent["left"] or parent["right"])
        yield row | {
            "kind": ["node"],
            "n_leaves": [leaves],
            "saved": [saved],
            "parent_conv_id": [parent["conv_id"] if known else None],
            "parent_key": [None if known else x["parent_key"]],
        }


def _merges(final: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[dict[str, object]]:
            group, held = None, []
            for batch in batches:
                for x in batch.to_pylist():
                    if held and x["unit"] // FAN_IN != group:
                        yield from merge(group, held, final)
                        held = []
                    group = x["unit"] // FAN_IN
                    held.append(x)
            if held:
                yield from merge(group, held, final)

        yield from _batches(parts())

    return run


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One stream a node, in the order of the ids."""
    key, state, done = None, None, []
    for batch in batches:
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k == key:
                state.update(b"," + ids)
            else:
                if state is not None:
                    done.append((key, state.digest()))
                key, state = k, hashlib.sha256(ids)
    if state is not None:
        done.append((key, state.digest()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*done)], ["key", "digest"])


# --- the whole ---


def trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    spark = turns.sparkSession
    known = staged(rebuilt(turns), "conversations")
    size = known.agg(F.sum(F.octet_length("ids")).alias("bytes")).first().bytes or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // 16 // SHARD_TURNS + 1)
    parts = staged(in_tasks(known.repartitionByRange(shards, "ids", "conv_id"), _shards, SCHEMA_DDL), "trie-shards")
    opens, closed, units = parts.filter("kind = 'open'"), [parts.filter("kind = 'node'")], max(shards, 2)
    while units > 1:
        units = -(-units // FAN_IN)
        group = F.floor(F.col("unit") / FAN_IN)
        together = opens.repartition(units, group).sortWithinPartitions("unit")
        merged = staged(in_tasks(together, _merges(units == 1), SCHEMA_DDL), "trie-merged")
        opens = merged.filter("kind = 'open'")
        closed.append(merged.filter("kind = 'node'"))
    ends = parts.filter("kind = 'ends'").repartition("key").sortWithinPartitions("key", "conv_id").select("key", "payload")
    digests = in_tasks(ends, _end_digests, "key binary, digest binary")

    keyed = closed[1]
    for more in closed[2:]:
        keyed = keyed.unionByName(more)
    root = keyed.filter("depth = 0").select("conv_id").first()
    parents = keyed.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("open_parent"))
    nodes = closed[0].unionByName(keyed.join(digests, "key", "left").withColumn("payload", F.col("digest")).drop("digest"))
    # Children of the root, the most frequent of open parents, need no look-up.
    settled = F.col("parent_key").isNull() | (F.col("depth") <= 1)
    at_root = F.when(F.col("depth") == 1, F.lit(root.conv_id if root else None)).otherwise(F.col("parent_conv_id"))
    direct = nodes.filter(settled).withColumn("parent_conv_id", at_root.cast("long"))
    looked_up = nodes.filter(~settled).join(parents, "parent_key").withColumn("parent_conv_id", F.col("open_parent"))
    nothing = F.lit(hashlib.sha256().digest())
    return direct.unionByName(looked_up.drop("open_parent")).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.lower(F.hex(F.coalesce("payload", nothing))).alias("ends_sha256"),
    )
