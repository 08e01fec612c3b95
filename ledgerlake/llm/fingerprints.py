"""Document fingerprints by one-permutation MinHash.

A text's words (A-Z lower-cased, cut at white space) form shingles of five words
(a shorter text is one shingle). Every shingle is hashed once; the top byte of
the hash names one of 256 bins, and each bin keeps its least hash. An empty bin
takes the value of another one by optimal densification: it asks bins in an order
that depends on its own number alone until one is filled, so two texts borrow
alike. Of each bin the low four bits are stored, packed as one hex digit. Two
unrelated values agree in one of sixteen cases; the likeness of two fingerprints
takes that share out again.

All of it is column expressions. Per row the work is in proportion to the text;
no shingle leaves its row.

``with_next`` puts each row beside its successor by id. Rows are dealt into
blocks of the id's order (quantiles of the id, cut evenly again where there are
many rows; rows of one very frequent id, or without one, by a hash of the text),
one shuffle brings a block together, and the first row of each block is also
handed to the block before it.

Defined results: a null text counts as empty; a text without words has the empty
fingerprint, which is like another empty one (1) and unlike any other (0); null
ids come first, and rows of one id are ordered by a hash of the text, then by the
text; the only row of a table is its own successor; an empty table gives no rows.
Ids are numbers. Only the id and the text are read, whatever other columns there
are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import ascii_lower, staged, text_or_empty

WORDS = 5
BINS = 256
DIGIT_BITS = 4
PROBES = 4  # bins that an empty bin asks one by one before it ranks all filled ones
QUANTILES = 256
BLOCK_ROWS = 2000

_REST = (1 << 56) - 1  # a hash without its top byte
_CHANCE = 1 / (1 << DIGIT_BITS)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row."""
    return F.transform(F.array(value), use)[0]


def _shingle_hashes(words: Column) -> Column:
    short = F.array(F.xxhash64(F.concat_ws(" ", words)))
    long = F.transform(
        F.sequence(F.lit(0), F.size(words) - WORDS),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WORDS)]),
    )
    return F.when(F.size(words) < WORDS, short).otherwise(long)


def _top(value: Column) -> Column:
    return F.shiftright(value, 56)


def _empty(value: Column) -> Column:
    """A bin that holds nothing but its own upper limit."""
    return value.bitwiseAND(F.lit(_REST)) == F.lit(_REST)


def _bins(hashes: Column) -> Column:
    """The least hash of each bin, by bin; the upper limit of an empty bin."""
    limits = F.array(*[F.lit((top << 56) | _REST) for top in range(-BINS // 2, BINS // 2)])
    return _let(
        F.sort_array(F.concat(hashes, limits)),
        lambda all_: F.filter(all_, lambda x, i: (i == 0) | (_top(x) != _top(F.get(all_, i - 1)))),
    )


def _densified(bins: Column) -> Column:
    """Empty bins take the value of the first filled bin in an order of their own."""

    def borrowed(i: Column, full: Column) -> Column:
        asked = [F.get(bins, F.pmod(F.xxhash64(i, F.lit(t)), F.lit(BINS)).cast("int")) for t in range(PROBES)]
        ranked = F.array_min(F.transform(full, lambda y: F.struct(F.xxhash64(i, _top(y)).alias("order"), y.alias("value"))))
        return F.coalesce(*[F.when(~_empty(y), y) for y in asked], ranked["value"])

    return _let(
        F.filter(bins, lambda x: ~_empty(x)),
        lambda full: F.transform(bins, lambda x, i: F.when(_empty(x), borrowed(i, full)).otherwise(x)),
    )


def fingerprint(text: Column) -> Column:
    """256 hex digits, or nothing for a text without words."""
    words = F.array_remove(F.split(ascii_lower(text), "[\\x20\\x09-\\x0D]+"), "")

    def packed(some: Column) -> Column:
        digits = _let(_bins(_shingle_hashes(some)), _densified)
        low = F.transform(digits, lambda x: F.lower(F.hex(x.bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)))))
        return F.when(F.size(some) > 0, F.array_join(low, "")).otherwise("")

    return _let(words, packed)


def likeness(left: Column, right: Column) -> Column:
    """Estimated share of common shingles (Jaccard) of the texts of two fingerprints."""
    width = 64 // DIGIT_BITS
    differing = F.lit(0)
    for start in range(1, BINS, width):
        a, b = (F.conv(F.substring(x, start, width), 16, -10).cast("long") for x in (left, right))
        x = a.bitwiseXOR(b)
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        differing = differing + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    agreeing = 1 - differing / BINS
    unbiased = F.greatest(F.lit(0.0), (agreeing - _CHANCE) / (1 - _CHANCE))
    return F.when((left == "") | (right == ""), (left == right).cast("double")).otherwise(unbiased)


def _dealt(docs: DataFrame, id_col: str, block_rows: int) -> DataFrame:
    """id, text and tie (a hash of the text), with the block (``seg``, ``sub``) of each row."""
    shares = [k / QUANTILES for k in range(1, QUANTILES)]
    seen = docs.agg(
        F.count("*").alias("n"), F.count(id_col).alias("named"), F.percentile_approx(id_col, shares, 10_000).alias("at")
    ).first()
    wanted = max(1, min(QUANTILES, seen.n // block_rows))
    bounds = [seen.at[round(k * QUANTILES / wanted) - 1] for k in range(1, wanted)] if seen.at else []
    parts = max(1, seen.n // (QUANTILES * block_rows))
    edges = sorted(set(bounds))
    often = [v for v in edges if bounds.count(v) > 1]  # an id that several quantiles fall on
    rows = docs.select("id", "text", F.xxhash64("text").alias("tie"))
    v, share = F.col("id"), F.col("tie") / F.lit(2.0**64) + 0.5
    unnamed = (share * ((seen.n - seen.named) // block_rows + 1)).cast("long")
    seg, sub = F.lit(0), F.lit(0).cast("long")
    if edges:
        known = F.array(*map(F.lit, edges))
        below = F.size(F.filter(known, lambda b: b < v))
        seg = 2 * F.size(F.filter(known, lambda b: b <= v))
        if parts > 1:
            low = F.coalesce(F.get(known, F.size(F.filter(known, lambda b: b <= v)) - 1), F.lit(edges[0]))
            high = F.coalesce(F.get(known, F.size(F.filter(known, lambda b: b <= v))), F.lit(edges[-1]))
            width = F.greatest(high - low, F.lit(1)).cast("double")
            sub = F.greatest(F.lit(0), F.least(F.lit(parts - 1), (v - low) / width * parts)).cast("long")
        if often:
            times = F.element_at(F.create_map(*[F.lit(x) for w in often for x in (w, bounds.count(w))]), v)
            crowd = v.isin(often)
            seg = F.when(crowd, 2 * below + 1).otherwise(seg)
            sub = F.when(crowd, (share * times * parts).cast("long")).otherwise(sub)
    return rows.withColumns(
        {"seg": F.when(v.isNull(), -1).otherwise(seg), "sub": F.when(v.isNull(), unnamed).otherwise(sub)}
    )


def with_next(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """id, text, fp, and next_text, next_fp of the row that follows by id; after the last row comes the first."""
    rows = _dealt(docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")), "id", block_rows)
    block = F.struct("seg", "sub")
    firsts = rows.groupBy("seg", "sub").agg(F.min(F.struct("id", "tie")).alias("first"))
    before = F.coalesce(  # one row a block
        F.lag(block).over(Window.orderBy("seg", "sub")),
        F.max(block).over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    )
    firsts = firsts.select(before.alias("to"), F.col("first.id").alias("first_id"), F.col("first.tie").alias("first_tie"))
    firsts = staged(firsts, "block-firsts")
    guests = (
        rows.drop("seg", "sub")
        .join(firsts, F.col("id").eqNullSafe(F.col("first_id")) & (F.col("tie") == F.col("first_tie")))
        .select("id", "text", "tie", "to.seg", "to.sub")
        .groupBy("seg", "sub")
        .agg(*[F.min(c).alias(c) for c in ("id", "text", "tie")])
        .select("id", "text", "tie", "seg", "sub")
    )
    every = rows.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
    every = every.withColumn("fp", fingerprint(F.col("text")))
    order = Window.partitionBy("seg", "sub").orderBy("guest", F.asc_nulls_first("id"), "tie", "text")
    every = every.withColumns({"next_text": F.lead("text").over(order), "next_fp": F.lead("fp").over(order)})
    return every.filter(~F.col("guest")).select(F.col("id").alias(id_col), "text", "fp", "next_text", "next_fp")


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Fingerprints of every text and of the text with its second half replaced by the start of the next."""
    pairs = with_next(docs, id_col, text_col, block_rows)
    n = F.char_length("text")
    cut = F.floor(n / 2).cast("int")
    mixed = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    # An array of one, taken apart again: what stands above reads the mixed text as a column and does not make it anew.
    pairs = pairs.select(id_col, n.cast("long").alias("n_chars"), "fp", "next_fp", F.explode(F.array(mixed)).alias("mixed"))
    pairs = pairs.select(
        id_col,
        "n_chars",
        F.sha2(F.col("mixed").cast("binary"), 256).alias("edited_sha256"),
        F.col("fp").alias("fingerprint"),
        F.explode(F.array(fingerprint(F.col("mixed")))).alias("edited_fingerprint"),
        "next_fp",
    )
    return pairs.select(
        id_col,
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fp")).alias("near_next"),
    )
