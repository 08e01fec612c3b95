"""Similarity join of word shingle sets by chosen paths.

Every text becomes its set of ``SHINGLE``-word shingles; texts with equal sets
are one class member from there on. Each set is embedded as ``COORDS`` minhash
values. A run starts with all sets in one node; a node samples coordinates, on
average 1 / ``LAMBDA`` of them, and hands each of its sets to the child that the
set's value there names. Nodes of up to ``SMALL`` sets are leaves, at depth
``DEPTH`` all others are too. In a leaf all pairs are compared. Two sets
whose similarity is the threshold share a leaf of one run with a probability
that the recursion gives; the number of runs follows from ``TARGET``.

In a leaf the minhash values themselves are compared first: pairs that agree in
at least ``SKETCH`` of them (four standard deviations below the threshold) may
be similar. Their connected components are the groups that are compared exactly,
shingle by shingle, each pair of sets once; other sets are done.

No pair of rows is ever emitted. Leaves with equal members are one leaf. Large
leaves and groups are cut into blocks, and each pair of blocks is a piece of
work of its own, so no task holds more than two blocks. What leaves a block pair
are the number of links of each set and the edges of a spanning forest;
connected components are found by passing on the least label, with tables in the
shared folder between the rounds.

Words are lower-cased and parted by white space. Texts with fewer than five
words have one shingle, all their words.

Defined results: a null text counts as empty; texts without words have no
shingles, are linked to nothing and form classes of their own, one per row id;
the class id is the least id of the class; rows that repeat id and text are
separate rows with the same class (``keep_one_per_class`` keeps one of them); an
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import in_tasks, settle, small_slices, staged, text_or_empty

SHINGLE = 5
THRESHOLD = 0.8
COORDS = 64
LAMBDA = 0.75
SMALL = 32
DEPTH = 3
TARGET = 0.999
SKETCH = 0.6
BLOCK_SETS = 1024
BLOCK_SHINGLES = 1_000_000
STRIP = 128  # rows of a matrix of pairs that wider numbers than booleans are made for at a time

_MIX = np.uint64(0x9E3779B97F4A7C15)


def runs_needed(threshold: float = THRESHOLD, target: float = TARGET) -> int:
    """Runs after which a pair at the threshold has met in a leaf of the last depth with probability ``target``."""
    meets = 1.0
    for _ in range(DEPTH):
        meets = 1 - math.exp(-meets * threshold / LAMBDA)
    return math.ceil(math.log(1 - target) / math.log(1 - meets))


def root_coordinates(runs: int) -> list[tuple[int, int]]:
    """(run, coordinate) pairs that the roots sample: one or two per run, 1 / LAMBDA on average."""
    rng = np.random.default_rng(11)
    out = []
    for run in range(runs):
        n = int((run + 1) / LAMBDA) - int(run / LAMBDA)
        out += [(run, int(c)) for c in rng.choice(COORDS, n, replace=False)]
    return out


# --- sets and signatures ---


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = (text or "").lower().split()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    total = np.zeros(n if words else 0, dtype=np.uint64)
    for k in range(width):
        total = (total ^ (total >> np.uint64(29))) * _MIX + hashes[k : k + n]
    total = (total ^ (total >> np.uint64(32))) * _MIX
    return np.unique(total ^ (total >> np.uint64(29)))


_FACTORS = np.random.default_rng(7).integers(1, 2**63, (2, COORDS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of COORDS minhash values (as int32) per set; sets are not empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), COORDS), dtype=np.int32)
    for k in range(COORDS):
        least = np.minimum.reduceat(flat * _FACTORS[0, k] + _FACTORS[1, k], starts)
        out[:, k] = (least >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def set_key(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, as two signed numbers."""
    high, low = np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), dtype=">i8")
    return int(high), int(low)


def sign(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, mark (hash of the text), hi and lo (the set's name; null without words), size and sig of every row."""
    mark = F.xxhash64(text_or_empty(text_col)).alias("mark")
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), mark)
    id_kind = narrow.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small_slices(batches):
            sets = [shingles(t) for t in part.column(1).to_pylist()]
            full = [s for s in sets if len(s)]
            signed = iter(signatures(full)) if full else iter(())
            keys = [set_key(s) if len(s) else (None, None) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(2),
                    pa.array([k[0] for k in keys], pa.int64()),
                    pa.array([k[1] for k in keys], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([next(signed) if len(s) else None for s in sets], pa.list_(pa.int32())),
                ],
                ["id", "mark", "hi", "lo", "size", "sig"],
            )

    return in_tasks(narrow, run, f"id {id_kind}, mark long, hi long, lo long, size int, sig array<int>")


# --- chosen paths ---


def children(node: Column, sig: Column) -> Column:
    """The children of a node that a set goes to: sampled coordinates with the set's value there."""
    odds = int(1_000_000 / (LAMBDA * COORDS))
    places = F.filter(F.sequence(F.lit(0), F.lit(COORDS - 1)), lambda k: F.pmod(F.xxhash64(node, k), F.lit(1_000_000)) < odds)
    return F.transform(places, lambda k: F.xxhash64(node, k, F.get(sig, k)))


def leaves(sets: DataFrame, runs: int) -> DataFrame:
    """(part, n, hi, lo): the members of all leaves with two or more sets, each membership once."""
    picked = [F.xxhash64(F.lit(run), F.lit(k), F.get("sig", F.lit(k))) for run, k in root_coordinates(runs)]
    rows = sets.select("hi", "lo", F.explode(F.array(*picked)).alias("node"))
    levels, found = [], []
    for depth in range(1, DEPTH + 1):
        nodes = rows.groupBy("node").agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("members")
        )
        nodes = staged(nodes.filter("n > 1"), f"nodes-{depth}")
        large = nodes.filter(F.col("n") > SMALL) if depth < DEPTH else nodes.filter(F.lit(False))
        levels.append(rows)
        found.append(nodes.filter(F.col("n") <= SMALL) if depth < DEPTH else nodes)
        if large.isEmpty():
            break
        inside = rows.join(large.select("node"), "node").select("node", "hi", "lo")
        split = inside.join(sets.select("hi", "lo", "sig"), ["hi", "lo"])
        rows = split.select("hi", "lo", F.explode(children(F.col("node"), F.col("sig"))).alias("node"))
        rows = staged(rows.distinct(), f"paths-{depth + 1}")
    distinct = None
    for nodes in found:
        distinct = nodes if distinct is None else distinct.unionByName(nodes)
    kept = staged(distinct.groupBy("n", "members").agg(F.min("node").alias("node")), "leaves")
    members = None
    for rows in levels:
        here = rows.select("node", "hi", "lo").join(kept, "node")
        members = here if members is None else members.unionByName(here)
    # A set can come to one node twice, when two samples of a run agree.
    return members.select(F.col("node").alias("part"), "n", "hi", "lo").distinct()


# --- comparing ---


def overlaps(sets: list[np.ndarray], strip: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Sizes of the intersections with all sets, by an inverted list of shingles: ``strip`` sets at a time, with their places."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    fresh = np.ones(len(flat), dtype=bool)
    np.not_equal(flat[1:], flat[:-1], out=fresh[1:])
    del flat
    number = np.cumsum(fresh, dtype=np.int32) - np.int32(1)
    column = np.empty_like(number)
    column[order] = number
    posting = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)[order]
    count = np.bincount(number).astype(np.int32)
    del order, fresh, number
    first = np.cumsum(count, dtype=np.int32) - count
    begin = np.cumsum(sizes) - sizes
    for start in range(0, len(sets), strip):
        here = slice(start, min(start + strip, len(sets)))
        out = np.empty((here.stop - start, len(sets)), dtype=np.int64)
        for k, row in enumerate(range(start, here.stop)):
            own = column[begin[row] : begin[row] + sizes[row]]
            length = count[own]
            jump = np.repeat(first[own] - np.cumsum(length, dtype=np.int32) + length, length)
            jump += np.arange(len(jump), dtype=np.int32)
            out[k] = np.bincount(posting[jump], minlength=len(sets))
        yield here, out


def exactly_similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets have a Jaccard similarity at the threshold or above, as a boolean matrix."""
    size = np.array([len(s) for s in sets])
    similar = np.empty((len(sets), len(sets)), dtype=bool)
    for here, shared in overlaps(sets, STRIP):
        similar[here] = shared >= threshold * (size[here, None] + size[None, :] - shared) - 1e-9
    return similar


def maybe_similar(sigs: np.ndarray, share: float) -> np.ndarray:
    """Which pairs of signatures agree in at least this share of their coordinates."""
    agree = np.zeros((len(sigs), len(sigs)), dtype=np.int16)
    for column in sigs.T:
        agree += column[:, None] == column[None, :]
    return agree >= share * sigs.shape[1]


def in_strips(pairs: np.ndarray) -> Iterator[np.ndarray]:
    return (pairs[start : start + STRIP] for start in range(0, len(pairs), STRIP))


def between_blocks(similar: np.ndarray, side: np.ndarray, one_block: bool) -> np.ndarray:
    """No pair of a row with itself; of two blocks, one of which may be empty, only the pairs between them."""
    np.fill_diagonal(similar, False)
    return similar if one_block else similar & (side[:, None] != side[None, :])


def spanning(similar: np.ndarray) -> list[tuple[int, int]]:
    """Edges from every member of a component to its first member."""
    label = np.arange(len(similar))
    while True:
        near = [np.where(part, label, len(label)).min(axis=1) for part in in_strips(similar)]
        least = np.minimum(label, np.concatenate(near))
        if (least == label).all():
            return [(k, int(at)) for k, at in enumerate(label) if at != k]
        label = least


LINKS = "hi long, lo long, hi2 long, lo2 long, links long, linked long"


def compare(pieces: DataFrame, similar_pairs: Callable[[list[dict]], np.ndarray]) -> DataFrame:
    """Links of every set, and spanning edges (hi2, lo2 not null), from the rows that a block pair has together."""

    def work(rows: list[dict]) -> list[tuple]:
        rows = list({(r["hi"], r["lo"]): r for r in rows}.values())  # texts that repeat come more than once
        one_block = rows[0]["i"] == rows[0]["j"]
        similar = between_blocks(similar_pairs(rows), np.array([r["side"] for r in rows]), one_block)
        copies = np.array([r["copies"] for r in rows])
        links, linked = similar.sum(axis=1), np.concatenate([part @ copies for part in in_strips(similar)])
        key = [(r["hi"], r["lo"]) for r in rows]
        out = [(*key[k], None, None, int(links[k]), int(linked[k])) for k in links.nonzero()[0]]
        return out + [(*key[a], *key[b], 0, 0) for a, b in spanning(similar)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, done = None, [], []

        def batch() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in zip(*done)] or [pa.array([], pa.int64())] * 6
            done.clear()
            return pa.RecordBatch.from_arrays(columns, ["hi", "lo", "hi2", "lo2", "links", "linked"])

        for part in small_slices(batches, rows=256):
            for row in part.to_pylist():
                here = (row["part"], row["i"], row["j"])
                if here != group and rows:
                    done += work(rows)
                    rows = []
                    if len(done) > 10_000:
                        yield batch()
                group = here
                rows.append(row)
        if rows:
            done += work(rows)
        yield batch()

    spread = pieces.repartition("part", "i", "j").sortWithinPartitions("part", "i", "j", "hi", "lo")
    return in_tasks(spread, run, LINKS)


def in_blocks(members: DataFrame, blocks: Column) -> DataFrame:
    """One row per block pair that a member takes part in: i, j and the side it is on."""
    own = members.withColumn("blocks", F.ceil(blocks).cast("int"))
    own = own.withColumn("own", F.pmod(F.hash("hi", "lo"), F.col("blocks")))
    paired = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return paired.select(
        *members.columns,
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
    )


def forest(results: DataFrame) -> DataFrame:
    """The edges (a, b) among compared rows."""
    a = F.struct("hi", "lo")
    b = F.struct(F.col("hi2").alias("hi"), F.col("lo2").alias("lo"))
    return results.filter("hi2 is not null").select(a.alias("a"), b.alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """(v, label) for every end of an edge (a, b): the least vertex of its component.

    Each round takes the least label among the neighbours, then the label of that label.
    """
    both = staged(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = staged(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("v"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("v")).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("v") == F.col("a")).select(
            "v", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        jump = labels.select(F.col("v").alias("at"), F.col("label").alias("further"))
        new = step.join(jump, F.col("label") == F.col("at"), "left").select(
            "v", "old", F.least("label", F.coalesce("further", "label")).alias("label")
        )
        new = staged(new, "labels")
        if new.filter(F.col("label") != F.col("old")).isEmpty():
            return new.select("v", "label")
        labels = new.select("v", "label")


def similar_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, target: float = TARGET
) -> DataFrame:
    """One row per row: id, ``class_id``, ``n_links`` (other rows at the threshold or above), ``n_linked_texts``, ``kept``."""
    classed = marked_classes(docs, id_col, text_col, threshold, target)
    return classed.select(F.col("id").alias(id_col), "class_id", "n_links", "n_linked_texts", "kept")


def marked_classes(docs: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """The same with the id as ``id``, ``mark``, the hash of the text (an id may repeat with another text), and
    ``class_hi`` and ``class_lo``, the name of a set of the class (null without words)."""
    signed = staged(sign(docs, id_col, text_col), "signatures")
    sets = staged(
        signed.filter("hi is not null")
        .groupBy("hi", "lo")
        .agg(
            F.min("id").alias("first_id"),
            F.count("*").alias("copies"),
            F.first("size").alias("size"),
            F.first("sig").alias("sig"),
        ),
        "sets",
    )
    # Which sets may be similar: leaves, compared by signature.
    members = leaves(sets, runs_needed(threshold, target)).join(sets.select("hi", "lo", "sig"), ["hi", "lo"])
    sketched = in_blocks(members.withColumn("copies", F.lit(1)), F.col("n") / BLOCK_SETS)
    near = compare(sketched, lambda rows: maybe_similar(np.array([r["sig"] for r in rows], dtype=np.int32), SKETCH))
    groups = components(forest(staged(near, "near-sets")))
    groups = groups.select("v.hi", "v.lo", F.xxhash64("label").alias("part")).join(
        sets.select("hi", "lo", "first_id", "copies", "size"), ["hi", "lo"]
    )
    groups = staged(groups, "near-groups")
    sizes = groups.groupBy("part").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"))

    # The texts of these sets, as sets again.
    wanted = groups.select(F.col("first_id").alias("wanted")).distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.join(staged(wanted, "near-ids"), F.col("id").eqNullSafe(F.col("wanted")), "left_semi").select("text")

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small_slices(batches):
            full = [s for s in map(shingles, part.column(0).to_pylist()) if len(s)]
            keys = [set_key(s) for s in full]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.int64()),
                    pa.array([k[1] for k in keys], pa.int64()),
                    pa.array([s.tobytes() for s in full], pa.binary()),
                ],
                ["hi", "lo", "hashes"],
            )

    hashes = in_tasks(texts, again, "hi long, lo long, hashes binary")
    placed = groups.join(staged(sizes, "near-sizes"), "part").select("part", "n", "shingles", "copies", "hi", "lo")
    blocks = F.greatest(F.col("n") / BLOCK_SETS, F.col("shingles") / BLOCK_SHINGLES)
    pieces = in_blocks(hashes.join(placed, ["hi", "lo"]), blocks)
    exact = compare(
        pieces, lambda rows: exactly_similar([np.frombuffer(r["hashes"], dtype=np.uint64) for r in rows], threshold)
    )
    results = staged(exact, "links")

    counts = results.filter("hi2 is null").groupBy("hi", "lo").agg(F.sum("links").alias("links"), F.sum("linked").alias("linked"))
    edges = forest(results)
    labels = components(edges).select("v.hi", "v.lo", "label")
    ids = sets.select("hi", "lo", "first_id")
    named = labels.join(ids, ["hi", "lo"])
    class_ids = named.groupBy("label").agg(F.min("first_id").alias("class_id"))
    linked = named.join(class_ids, "label").join(counts, ["hi", "lo"], "left").select(
        "hi", "lo", "label", "class_id", "links", "linked"
    )
    linked = staged(linked, "linked-sets")
    every = sets.select("hi", "lo", "first_id", "copies").join(linked, ["hi", "lo"], "left").select(
        "hi",
        "lo",
        F.coalesce("class_id", "first_id").alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        F.coalesce("links", F.lit(0)).alias("n_linked_texts"),
        F.coalesce("label.hi", "hi").alias("class_hi"),
        F.coalesce("label.lo", "lo").alias("class_lo"),
    )
    with_words = signed.filter("hi is not null").select("id", "mark", "hi", "lo").join(staged(every, "set-classes"), ["hi", "lo"])
    without = signed.filter("hi is null").select(
        "id", "mark", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_linked_texts"),
        F.lit(None).cast("long").alias("class_hi"), F.lit(None).cast("long").alias("class_lo"),
    )
    return with_words.select(*without.columns).unionByName(without).select(
        "*", F.col("id").eqNullSafe(F.col("class_id")).alias("kept")
    )


def keep_one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every class, with the columns of the input.

    It is the one with the least id (a null id comes last); of several rows with that id the one with the least hash of
    its text, and of rows that repeat id and text one. Texts without words stay. Only rows of classes with several
    members are looked at, and of the rows themselves only those in question are shuffled.
    """
    classed = marked_classes(docs, id_col, text_col).filter("class_hi IS NOT NULL AND (n_links > 0 OR n_linked_texts > 0)")
    classed = staged(classed.select("class_hi", "class_lo", "id", "mark"), "class-members")
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "mark")
    firsts = classed.groupBy("class_hi", "class_lo").agg(F.min(order).alias("first"))
    members = classed.groupBy("class_hi", "class_lo", "id", "mark").agg(F.count("*").alias("n"))
    judged = staged(members.join(firsts, ["class_hi", "class_lo"]), "class-judged")
    stays = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("mark") == F.col("first.mark"))
    gone = judged.filter(~stays).select("id", "mark").distinct()
    repeated = judged.filter(stays & (F.col("n") > 1)).select("id", "mark").distinct()
    return settle(docs, id_col, text_col, staged(gone, "near-copies"), staged(repeated, "near-repeated"))
