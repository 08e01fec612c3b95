"""Packing token sequences by non-negative least squares over the histogram of lengths.

Documents are tokenised, closed with id 0, and cut into whole windows and a
rest. How often each length occurs is a table of at most ``WINDOW`` rows. All
combinations of up to ``DEPTH`` lengths that fill a window exactly are listed;
non-negative least squares finds how often to use each so that together they use
up the histogram; the counts are rounded, never beyond what is there, and what
remains is packed greedily, again by histogram: the longest length first, then
the longest that still fits. Nothing in this plan grows with the corpus.

Each piece then needs a rank among the pieces of its length. Ranks are taken in
buckets of about ``BUCKET`` pieces, with the buckets' sums before them, so that
a length that a third of all pieces have is spread over many tasks.

Defined results: a null text counts as empty and is one piece, id 0 alone; rows
that repeat id and text are packed once each; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import held, in_tasks, small_slices, staged

WINDOW = 1024
DEPTH = 3
BUCKET = 50_000
STEPS = 400
CACHE = 500_000  # words whose ids a worker keeps

# --- tokens ---

# The tokenizer's own word pattern, for texts where both engines agree on letters, numbers and blanks.
_WORD = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_ASCII_OTHER = re.compile("[\x1c-\x1f]")
_OTHER = re.compile("[\x1c-\x1f\x85\xa0\xb2\xb3\xb9\xbc-\xbeɐ-\U0010ffff]")
# A byte-level vocabulary writes these bytes as the characters of their number, the others from 256 on.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}


class _Words(dict):
    """Ids of words as bytes, worked out when first asked for."""

    def __init__(self, tokenizer):
        other = iter(range(256, 512))
        self.shown = {b: b if b in _SHOWN else next(other) for b in range(256)}
        self.model = tokenizer.model

    def __missing__(self, word: str) -> bytes:
        spelled = word.encode().decode("latin-1").translate(self.shown)
        ids = self[word] = array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
        return ids


class Encoder:
    """Token ids as little-endian 32-bit bytes; the ids of a word are looked up once.

    Texts with an added token, or characters that the pattern may see
    differently, go to the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.known = _Words(self.tokenizer)

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > CACHE:  # those that came first are the frequent ones
            kept = list(islice(self.known.items(), CACHE // 2))
            self.known.clear()
            self.known.update(kept)
        ids_of = self.known.__getitem__
        return [self._whole(t) if self._odd(t) else b"".join(map(ids_of, _WORD.findall(t))) for t in texts]

    def _odd(self, text: str) -> bool:
        other = _ASCII_OTHER if text.isascii() else _OTHER
        return bool(other.search(text) or (self.added and self.added.search(text)))

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()  # four bytes each, the lowest first


def pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, start, length, ids_crc32 and doc_tokens of every piece; ``vocabulary`` is a path on every machine."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_kind = narrow.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held(("encoder", vocabulary), lambda: Encoder(vocabulary))
        for part in small_slices(batches):
            owner, rows = [], []
            for k, ids in enumerate(encoder.encode([t or "" for t in part.column(1).to_pylist()])):
                ids += bytes(4)
                total = len(ids) // 4
                for start in range(0, total, WINDOW):
                    cut = ids[4 * start : 4 * (start + WINDOW)]
                    owner.append(k)
                    rows.append((start, len(cut) // 4, zlib.crc32(cut), total))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            if rows:
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)), *columns], names)

    names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
    schema = f"id {id_kind}, start long, length long, ids_crc32 long, doc_tokens long"
    return in_tasks(narrow, run, schema, holds=True)


# --- the plan, on the histogram ---


def combinations(window: int = WINDOW) -> np.ndarray:
    """All combinations of one to three lengths that fill a window; 0 pads the shorter ones."""
    rows = [np.array([[window, 0, 0]])]
    short = np.arange(1, window // 2 + 1)
    rows.append(np.column_stack([window - short, short, 0 * short]))
    for least in range(1, window // 3 + 1):
        middle = np.arange(least, (window - least) // 2 + 1)
        rows.append(np.column_stack([window - least - middle, middle, 0 * middle + least]))
    return np.concatenate(rows)


def least_squares(combos: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - histogram|, by accelerated projected gradients."""
    size = len(histogram)

    def used(x: np.ndarray) -> np.ndarray:
        total = np.bincount(combos.ravel(), weights=np.repeat(x, combos.shape[1]), minlength=size)
        total[0] = 0
        return total

    def back(rest: np.ndarray) -> np.ndarray:
        return rest[combos].sum(axis=1)

    probe = np.ones(len(combos))
    for _ in range(20):  # the largest eigenvalue gives the step
        probe = back(used(probe))
        bound = np.linalg.norm(probe)
        probe /= bound
    x = point = np.zeros(len(combos))
    pace = 1.0
    for _ in range(steps):
        new = np.maximum(0, point - back(used(point) - histogram) / bound)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        point = new + (pace - 1) / faster * (new - x)
        x, pace = new, faster
    return x


def plan(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats): combinations that together use up the histogram (counts by length) exactly."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    combos = combinations(window)
    wanted = np.rint(least_squares(combos, left.astype(float))).astype(np.int64)
    found: list[tuple[tuple[int, ...], int]] = []
    for k in np.argsort(-wanted, kind="stable"):
        if not wanted[k]:
            break
        lengths = tuple(int(n) for n in combos[k] if n)
        found += _take(left, lengths, int(wanted[k]))
    while left.any():
        row: list[int] = []
        space = window
        while True:
            spare = left[: space + 1].copy()
            for n in row:
                if n <= space:
                    spare[n] -= 1
            fits = (spare > 0).nonzero()[0]
            if not len(fits):
                break
            row.append(int(fits[-1]))
            space -= row[-1]
        found += _take(left, tuple(row), int(left.sum()))
    return found


def _take(left: np.ndarray, lengths: tuple[int, ...], most: int) -> list[tuple[tuple[int, ...], int]]:
    """Use a combination as often as wanted and possible."""
    repeats = min(most, *(int(left[n]) // lengths.count(n) for n in set(lengths)))
    if repeats <= 0:
        return []
    for n in lengths:
        left[n] -= repeats
    return [(lengths, repeats)]


class Places:
    """Rank among the pieces of a length to sequence and offset."""

    def __init__(self, combos: list[tuple[tuple[int, ...], int]]):
        rows, taken, base = [], {}, 0
        for lengths, repeats in combos:
            offsets: dict[int, list[int]] = {}
            at = 0
            for n in lengths:
                offsets.setdefault(n, []).append(at)
                at += n
            for n, own in offsets.items():
                first = taken.get(n, 0)
                taken[n] = first + repeats * len(own)
                rows.append((n, first, base, len(own), own))
            base += repeats
        rows.sort(key=lambda r: r[:2])
        self.key = np.array([(r[0] << 48) + r[1] for r in rows], dtype=np.int64)
        self.first, self.base, self.times = (np.array([r[k] for r in rows], dtype=np.int64) for k in (1, 2, 3))
        self.begin = np.cumsum(self.times) - self.times
        self.offsets = np.array([o for r in rows for o in r[4]], dtype=np.int64)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.searchsorted(self.key, (length << 48) + rank, side="right") - 1
        inside = rank - self.first[row]
        return self.base[row] + inside // self.times[row], self.offsets[self.begin[row] + inside % self.times[row]]


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its sequence and its offset there."""
    cut = staged(pieces(docs, vocabulary, id_col, text_col), "pieces")
    histogram = np.zeros(WINDOW + 1, dtype=np.int64)
    for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect():  # at most WINDOW rows
        histogram[r.length] = r.n
    places = Places(plan(histogram))
    buckets = max(1, -(-int(histogram.max()) // BUCKET))
    spread = cut.withColumn("bucket", F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        spread.groupBy("length", "bucket")
        .agg(F.count("*").alias("n"))
        .select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    inside = Window.partitionBy("length", "bucket").orderBy("id", "start", "ids_crc32", "doc_tokens")
    ranked = spread.withColumn("place", F.row_number().over(inside)).join(sums, ["length", "bucket"])
    ranked = ranked.select(
        "id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("place") - 1).alias("rank")
    )
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.find(batch.column(2).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names)

    id_kind = cut.schema["id"].dataType.simpleString()
    out = in_tasks(
        ranked,
        run,
        f"id {id_kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
    return out.withColumnRenamed("id", id_col)
