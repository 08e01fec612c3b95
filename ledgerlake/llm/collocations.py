"""Frequent phrases that hang together, found by Rabin-Karp fingerprints.

A-Z are lower-cased, texts cut into pieces at ``.,;:!?`` and line ends, pieces into
words at blanks and tabs. A task joins the bytes of its texts, takes prefix sums
of a polynomial over them, and reads a word's hash off two sums; prefix sums over
the word hashes give the fingerprint of every phrase of k words the same way. A
phrase has a fingerprint and an independent check value. Each task adds up equal
fingerprints, Spark adds up the tasks, with the least and the largest check and a
pointer to a text that holds the phrase (half of the text's hash).

Phrases are counted length by length. One of k words can only be frequent if its
first and its last k - 1 words are, so a pass sends only phrases whose parts pass
a bitmap of the frequent fingerprints of the pass before. The bitmap has a fixed
size and no false negatives: a full one costs shuffled rows, never a result.

Where check values of one fingerprint differ, texts have collided: its occurrences
are read again and counted by their words. Phrases themselves are cut out of the
texts only for frequent fingerprints, and must give the fingerprint and the check
value they were asked for.

Defined results: a null text counts as empty, a null language as ``und``; repeated
rows count each; a text without words adds nothing; an empty table gives no rows.
Ids are not read. A task holds its slice of texts (at least one whole text) about
forty times over, and a bounded table of fingerprints.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import in_tasks, small_slices, staged, text_or_empty

LONGEST = 5
LEAST = 100  # occurrences of a frequent phrase
TOP = 2000  # phrases a language
FILTER_BITS = 1 << 27
SLICE = 1 << 20  # bytes of text hashed at once
HELD = 1_000_000  # fingerprints that a task adds up before it sends them
RANK_SLICES = 64

_KIND = np.zeros(256, dtype=np.uint8)  # 0 in a word, 1 blank, 2 end of a piece
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\v\f\r"]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

# A mark holds the upper half of a check value, and in its lower half that of a text's hash: the least mark of a phrase
# points to a text, and the least and the most agree above unless phrases have collided.
COUNTED = "lang string, fp long, n long, least long, most long"
HALF = np.uint64(32)


# --- hashing ---


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole number."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Polynomial:
    """Prefix sums of a polynomial modulo 2**64, from which the hash of any stretch is read off."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.byte = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", self.base), ("down", self.inverse)):
                powers = np.full(size, base, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers, dtype=np.uint64))

    def stretches(self, values: np.ndarray, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        """Hashes of values[start:end], wherever they stand."""
        self._powers(len(values))
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.up[: len(values)], out=sums[1:])
        return (sums[end] - sums[start]) * self.down[start]

    def words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix(self.stretches(self.byte[data], start, end) + (end - start).astype(np.uint64))

    def grams(self, words: np.ndarray, k: int) -> np.ndarray:
        """Hash of every k words in a row, over the ends of pieces as well."""
        n = len(words) - k + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return _mix(self.stretches(words, slice(0, n), slice(k, k + n)) + np.uint64(k))


_HASHES: list[Polynomial] = []


def _hashes() -> list[Polynomial]:
    """The fingerprint's and the check's polynomial, with their powers, kept by a worker process."""
    if not _HASHES:
        _HASHES.extend(Polynomial(base) for base in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93))
    return _HASHES


class Slice:
    """The words of some texts, and the hashes of their phrases."""

    def __init__(self, texts: pa.Array, fp_mask: int):
        self.mask = np.uint64(fp_mask)
        at = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        raw = np.frombuffer(raw, dtype=np.uint8)[at[0] : at[-1]] if raw is not None else np.zeros(0, dtype=np.uint8)
        at = at.astype(np.int64) - at[0]
        self.data = _LOWER[raw]
        kind = _KIND[self.data]
        inside = kind == 0
        edges = at[:-1][at[:-1] < len(inside)]  # first bytes of texts
        before = np.zeros(len(inside), dtype=bool)
        before[1:] = inside[:-1]
        before[edges] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.zeros(len(inside), dtype=bool)
        after[:-1] = inside[1:]
        after[edges[edges > 0] - 1] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.doc = np.searchsorted(at, self.start, side="right") - 1
        piece = np.searchsorted(np.flatnonzero(kind == 2), self.start)
        self.follows = (piece[1:] == piece[:-1]) & (self.doc[1:] == self.doc[:-1])
        self.hashed = [h.words(self.data, self.start, self.end) for h in _hashes()]

    def whole(self, k: int) -> np.ndarray:
        """For every place, whether k words from there stand in one piece."""
        n = max(0, len(self.start) - k + 1)
        good = np.ones(n, dtype=bool)
        for step in range(k - 1):
            good &= self.follows[step : step + n]
        return good

    def fingerprints(self, k: int) -> np.ndarray:
        return _hashes()[0].grams(self.hashed[0], k) & self.mask

    def checks(self, k: int) -> np.ndarray:
        return _hashes()[1].grams(self.hashed[1], k) >> HALF

    def marks(self, k: int, docs: np.ndarray) -> np.ndarray:
        """A mark for each place; ``docs`` has a hash of every text."""
        low = docs.view(np.uint64)[self.doc[: len(self.doc) - k + 1]] >> HALF
        return ((self.checks(k) << HALF) | low[: max(0, len(self.start) - k + 1)]).view(np.int64)

    def phrase(self, place: int, k: int) -> bytes:
        return b" ".join(self.data[self.start[j] : self.end[j]].tobytes() for j in range(place, place + k))


def _passes(bitmap: np.ndarray, fp: np.ndarray) -> np.ndarray:
    at = fp & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


# --- counting ---


def _added(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Rows of equal fingerprints added up: fp, n, least and most mark."""
    order = np.argsort(columns[0], kind="stable")
    fp, n, least, most = (c[order] for c in columns)
    first = np.flatnonzero(np.append(True, fp[1:] != fp[:-1])) if len(fp) else np.zeros(0, dtype=np.int64)
    if not len(first):
        return columns
    return [
        fp[first],
        np.add.reduceat(n, first),
        np.minimum.reduceat(least, first),
        np.maximum.reduceat(most, first),
    ]


def _count(k: int, filter_: Broadcast | None, fp_mask: int):
    """Rows of COUNTED for phrases of k words; for single words also a row without fingerprint, with their number."""

    def rows(lang: str, columns: list[np.ndarray]) -> pa.RecordBatch:
        arrays = [pa.repeat(lang, len(columns[0])), *(pa.array(c.view(np.int64)) for c in columns)]
        return pa.RecordBatch.from_arrays(arrays, _names(COUNTED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[list[np.ndarray]]] = {}
        words: Counter[str] = Counter()
        total = 0
        for part in small_slices(batches, 4096, SLICE):
            some = Slice(part.column(1), fp_mask)
            if not len(some.start):
                continue
            place = some.whole(k)
            if filter_ is not None:
                frequent = _passes(filter_.value, some.fingerprints(k - 1))
                place &= frequent[: len(place)] & frequent[1 : len(place) + 1]
            place = np.flatnonzero(place)
            fp, mark = some.fingerprints(k)[place], some.marks(k, part.column(2).to_numpy())[place]
            langs, code = np.unique(np.array(part.column(0).to_pylist(), dtype=object).astype(str), return_inverse=True)
            of_place = code[some.doc[place]]
            for c, lang in enumerate(langs.tolist()):
                own = of_place == c
                one = np.ones(int(own.sum()), dtype=np.int64)
                added = _added([fp[own], one, mark[own], mark[own]])
                held.setdefault(lang, []).append(added)
                total += len(added[0])
                if k == 1:
                    words[lang] += len(one)
            if total > HELD:
                total = 0
                for lang, parts in held.items():
                    held[lang] = [_added([np.concatenate(x) for x in zip(*parts)])]
                    total += len(held[lang][0][0])
                if total > HELD // 2:
                    for lang, parts in held.items():
                        yield rows(lang, parts[0])
                    held, total = {}, 0
        for lang, parts in held.items():
            yield rows(lang, _added([np.concatenate(x) for x in zip(*parts)]))
        if words:
            columns = [[*words], [None] * len(words), [*words.values()], [0] * len(words), [0] * len(words)]
            kinds = [pa.string(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], _names(COUNTED))

    return run


def _names(ddl: str) -> list[str]:
    return [x.split()[0] for x in ddl.split(", ")]


def _bitmap(fps: DataFrame, column: str, bits: int) -> np.ndarray | None:
    """A bit for each fingerprint modulo ``bits``; at most bits / 8 bytes reach the driver."""
    at = F.col(column).bitwiseAND(F.lit(bits - 1)) + 1
    sets = fps.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
    )
    out, found = np.zeros(max(bits, 1 << 15) // 8, dtype=np.uint8), False
    for r in sets.collect():
        part = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
        out[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = part
        found = True
    return out[: bits // 8] if found else None


def _spelled(k: int, filter_: Broadcast, fp_mask: int):
    """Occurrences of some fingerprints, counted by their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small_slices(batches, 4096, SLICE):
            some = Slice(part.column(1), fp_mask)
            place = some.whole(k)
            fp, mark = some.fingerprints(k).view(np.int64), some.marks(k, part.column(2).to_numpy())
            place = np.flatnonzero(place & _passes(filter_.value, fp.view(np.uint64)))
            langs = part.column(0).to_pylist()
            seen: Counter = Counter()
            for p in place.tolist():
                seen[langs[some.doc[p]], int(fp[p]), int(mark[p]), some.phrase(p, k)] += 1
            if seen:
                columns = [*zip(*seen), tuple(seen.values())]
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], _names(SPELLED))

    return run


SPELLED = "lang string, fp long, mark long, phrase binary, n long"


# --- phrases ---


def _pointed(filter_: Broadcast):
    """The texts that pointers may mean."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy().view(np.uint64) >> HALF
            yield batch.filter(pa.array(_passes(filter_.value, at)))

    return run


def _cut_out(fp_mask: int):
    """The wanted phrases of each text; both hashes of what is cut out have to agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small_slices(batches, 64, SLICE):
            out = []
            for row in range(part.num_rows):
                some = Slice(part.column(1).slice(row, 1), fp_mask)
                lang, wanted = part.column(0)[row].as_py(), part.column(2)[row].as_py()
                for k in sorted({w["k"] for w in wanted}):
                    asked = {(w["fp"], w["mark"] >> 32 & 0xFFFFFFFF): w["n"] for w in wanted if w["k"] == k}
                    fp, check = some.fingerprints(k).view(np.int64), some.checks(k).view(np.int64)
                    place = np.flatnonzero(some.whole(k) & np.isin(fp, np.array([f for f, _ in asked])))
                    for p in place.tolist():
                        n = asked.pop((int(fp[p]), int(check[p])), None)
                        if n is not None:
                            out.append((lang, k, some.phrase(p, k).decode(), n))
            if out:
                kinds = [pa.string(), pa.int32(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], _names(PHRASES))

    return run


PHRASES = "lang string, k int, phrase string, n long"


def frequent_phrases(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    least: int = LEAST,
    bits: int = FILTER_BITS,
    fp_mask: int = (1 << 64) - 1,
) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, n) of all phrases of up to five words with n >= least; (lang, n) of all words.

    ``fp_mask`` narrows the fingerprints, so that tests can have collisions.
    """
    context = docs.sparkSession.sparkContext
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    rows = docs.select(lang.alias("lang"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("doc", F.xxhash64("lang", "text"))  # the pointer: any row with this text will do
    levels, filter_, totals = [], None, None
    for k in range(1, LONGEST + 1):
        counted = in_tasks(rows, _count(k, filter_, fp_mask), COUNTED).groupBy("lang", "fp")
        counted = counted.agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
        counted = staged(counted.filter((F.col("n") >= least) | F.col("fp").isNull()), f"phrases-{k}")
        if k == 1:
            totals = counted.filter("fp IS NULL").select("lang", "n")
            counted = counted.filter("fp IS NOT NULL")
        upper = lambda mark: F.shiftright(mark, 32)
        same = upper(F.col("least")) == upper(F.col("most"))
        alike = counted.filter(same).select("lang", F.lit(k).alias("k"), "fp", F.col("least").alias("mark"), "n")
        mixed = counted.filter(~same).select("lang", "fp")
        suspects = _bitmap(mixed, "fp", bits)
        if suspects is not None:
            spelled = in_tasks(rows, _spelled(k, context.broadcast(suspects), fp_mask), SPELLED)
            spelled = spelled.groupBy("lang", "fp", "phrase").agg(F.min("mark").alias("mark"), F.sum("n").alias("n"))
            apart = spelled.join(mixed, ["lang", "fp"], "left_semi").filter(F.col("n") >= least).drop("phrase")
            alike = staged(alike.unionByName(apart.withColumn("k", F.lit(k))), f"phrases-apart-{k}")
        levels.append(alike)
        bitmap = _bitmap(alike, "fp", bits)
        if bitmap is None:
            break
        filter_ = context.broadcast(bitmap)
    frequent = levels[0]
    for level in levels[1:]:
        frequent = frequent.unionByName(level)
    frequent = frequent.withColumn("half", F.col("mark").bitwiseAND(F.lit((1 << 32) - 1)))
    pointers = _bitmap(frequent, "half", bits)
    if pointers is None:
        return docs.sparkSession.createDataFrame([], PHRASES), totals
    wanted = frequent.groupBy("lang", "half").agg(F.collect_list(F.struct("k", "fp", "mark", "n")).alias("wanted"))
    texts = in_tasks(rows, _pointed(context.broadcast(pointers)), "lang string, text string, doc long")
    texts = texts.groupBy("lang", "doc").agg(F.first("text").alias("text"))  # copies are one text
    texts = texts.withColumn("half", F.shiftrightunsigned("doc", 32))
    held = texts.join(wanted, ["lang", "half"]).select("lang", "text", "wanted")
    # Two texts may share half a hash; a phrase that both hold is cut out twice.
    return staged(in_tasks(held, _cut_out(fp_mask), PHRASES).distinct(), "phrases"), totals


def _words(phrase: Column) -> Column:
    return F.split(phrase, " ")


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    least: int = LEAST,
    top: int = TOP,
    **hashing: int,
) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score."""
    phrases, totals = frequent_phrases(docs, lang_col, text_col, least, **hashing)
    candidates = phrases.filter("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"))
    words = _words(F.col("phrase"))
    parts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select(
        "*",
        F.array_join(F.slice(words, F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice(words, F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("right"),
    )
    for side, name in (("left", "l"), ("right", "r")):
        counts = phrases.select("lang", F.col("phrase").alias(side), F.col("n").alias(name))
        parts = parts.join(counts, ["lang", side])
    parts = parts.join(totals, "lang")
    # 19 digits each: the products need up to 38 and are exact as decimals.
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    parts = parts.withColumn("above", F.lit(1000).cast("decimal(4,0)") * exact["a"] * exact["n"])
    parts = parts.withColumn("below", exact["l"] * exact["r"])
    worst = F.min(F.struct(F.expr("above div below").alias("score"), "cut", "l", "r")).alias("worst")
    scored = parts.groupBy("lang", "k", "phrase", "a", "n").agg(worst)

    # Shorter phrases inside a candidate, each with the most frequent candidate around it.
    places = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("k") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("k") - size + 1), lambda at: F.array_join(F.slice(words, at, size), " ")
            ),
        )
    )
    around = candidates.filter("k > 2").select("lang", F.explode(places).alias("phrase"), "a")
    around = around.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    scored = scored.join(around, ["lang", "phrase"], "left")
    scored = scored.filter(F.col("longer").isNull() | (100 * F.col("longer") < 100 * F.col("a")))

    # A language's phrases are cut down in slices before they meet in one task.
    order = [F.desc("worst.score"), F.desc("a"), F.asc("phrase")]
    piece = F.pmod(F.xxhash64("phrase"), F.lit(RANK_SLICES))
    sliced = scored.withColumn("slice", piece)
    sliced = sliced.withColumn("place", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order)))
    ranked = sliced.filter(F.col("place") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        "a",
        F.col("worst.l").alias("l"),
        F.col("worst.r").alias("r"),
        "n",
        F.col("worst.score").alias("score"),
    )
