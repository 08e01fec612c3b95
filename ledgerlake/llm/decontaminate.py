"""Benchmark decontamination by templates, in DataFrame functions only.

Numbers (with spelled ones), units and names become typed placeholders that keep
their value beside them. A word is a name by its own letters alone, whatever stands
around it, so an item has the same template wherever it is copied to. Windows of
``WINDOW`` template tokens of documents are hash-joined with those of the benchmark,
so a question whose numbers or names were changed still matches. Beside them go
windows in which only numbers are placeholders, so a copy in lower case or capitals
matches too; an item's window counts if either kind matches.
Where windows hold placeholders, the values on both
sides of one alignment must stand for each other one to one; windows of an
alignment that fails this test count only where they hold words alone.

A document is contaminated by an item when at least ``MIN_WINDOWS`` different
windows of the item match (13 tokens in a row give 6 windows of 8), or all
windows of an item that has fewer. Items of less than ``WINDOW`` tokens match as a
whole; those of less than ``TYPED_TOKENS`` only word by word, in any case and with
their own numbers and names, as their templates could not be told from prose.

Defined results: null texts and items count as empty and never match; items with
equal templates and values are searched as one, under their smallest id; rows that repeat
id and text give one result; an empty table on either side gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import matching, settle, staged, text_or_empty

WINDOW = 8
TYPED_TOKENS = 5
MIN_WINDOWS = 6
# Benchmark windows (8 bytes each) up to which they are broadcast; beyond, the join shuffles.
BROADCAST_WINDOWS = 1_000_000

# Placeholder marks: three code points for private use.
NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002"
MARKS = "\ue000-\ue002"
# Kinds of windows: all placeholders, those of numbers only, or none.
TYPED, WORDED, PLAIN = 0, 1, 2
# Bytes of text that one task of the second step looks at.
TASK_BYTES = 1 << 20
# Spelled numbers and units.
SPELLED = "two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|twenty|thirty|forty|fifty|hundred|thousand|million"
FIRST_LETTERS = "".join(sorted({w[0] for w in SPELLED.split("|")}))
UNITS = (
    "mm|cm|m|km|inch|inches|feet|foot|miles|mile|meters|metres|meter|metre|g|kg|mg|grams|gram|pounds|pound|tons|ton|"
    "l|ml|liters|litres|liter|litre|s|ms|sec|seconds|second|min|minutes|minute|h|hours|hour|days|day|weeks|week|"
    "months|month|years|year|dollars|dollar|cents|cent|euros|euro|usd|eur|percent|degrees|degree|mph|kmh|kw|watts|watt"
)


# Capitalised words, first in their sentence or not: what stands before a copied item must not matter.
NAMES = r"\p{Lu}(?<![\p{L}\p{N}]\p{Lu})(?<!\p{L}['’]\p{Lu})\p{Ll}++(?!\p{Lu})"
# Those inside a sentence: what stands before the blank does not end one.
INNER_NAMES = r"(?<=[\p{Ll}\p{N},;]\s)\p{Lu}\p{Ll}++(?!\p{Lu})"


def marked_text(text: Column, pattern: str = NAMES) -> Column:
    """Lower-case words and marked values, parted by white space; all else is taken out."""
    has_digit = text.rlike(r"\p{N}")
    apart = F.when(has_digit, F.regexp_replace(text, r"(?<=\p{N})(?=\p{L})", " ")).otherwise(text)
    digits = F.when(
        has_digit, F.regexp_replace(apart, r"\p{N}++(?:[.,:/]\p{N}++)*", f"{NUMBER}$0")
    ).otherwise(apart)
    names = F.regexp_replace(digits, pattern, f"{NAME}$0")
    # "Two" is a number and no name.
    # What stands before the word is looked at only where its first letter fits.
    numbers = F.regexp_replace(
        F.lower(names),
        rf"{NAME}?(?=[{FIRST_LETTERS}])(?<![\p{{L}}\p{{N}}{NUMBER}{UNIT}]{NAME}?)((?:{SPELLED})(?![\p{{L}}\p{{N}}]))",
        f"{NUMBER}$1",
    )
    units = F.when(
        numbers.contains(NUMBER),
        F.regexp_replace(numbers, rf"(?<={NUMBER}[^\s]{{1,20}}\s){NAME}?((?:{UNITS})(?![\p{{L}}\p{{N}}]))", f"{UNIT}$1"),
    ).otherwise(numbers)
    return F.regexp_replace(units, rf"[^\p{{L}}\p{{N}}{MARKS}\s]++", "")


def as_tokens(marked: Column) -> Column:
    return F.array_remove(F.split(marked, r"\s+"), "")


def valued(token: Column, kind: int) -> Column:
    """A marked token as windows of this kind see it, with its value."""
    if kind == TYPED:
        return token
    gone = NAME + UNIT if kind == WORDED else NUMBER + NAME + UNIT
    return F.translate(token, gone, "")


def templated(token: Column, kind: int) -> Column:
    """The same without its value: from a mark on, only the mark is left. Most tokens have no mark and stay as they are."""
    marked = F.contains(token, F.lit(NUMBER)) | F.contains(token, F.lit(NAME)) | F.contains(token, F.lit(UNIT))
    return F.when(marked, F.regexp_replace(valued(token, kind), rf"([{MARKS}]).*", "$1")).otherwise(token)


def of_kind(marked: Column, kind: int) -> Column:
    """The marked text with the placeholders of this kind of windows."""
    gone = {TYPED: "", WORDED: NAME + UNIT, PLAIN: MARKS}[kind]
    return F.regexp_replace(marked, f"[{gone}]", "") if gone else marked


def without_values(marked: Column) -> Column:
    return F.regexp_replace(marked, rf"([{MARKS}])\S*", "$1")


def window_hash(tokens: Column, place: Column, width: int) -> Column:
    return F.xxhash64(F.slice(tokens, place, width))


def window_hashes(rows: DataFrame, keys: list[str], widths: list[int]) -> DataFrame:
    """keys and hash of the windows of every width of the rows' ``tokens``, as ``window_hash`` has them.

    Windows are rows and no elements of an array, so that Spark compiles the step.
    """
    shortest = min(widths)
    places = F.sequence(F.lit(0), F.size("tokens") - shortest)
    at = rows.filter(F.size("tokens") >= shortest).select(*keys, "tokens", F.explode(places).alias("place"))

    def of_width(width: int) -> Column:
        hashed = F.xxhash64(*[F.get("tokens", F.col("place") + k) for k in range(width)])
        return F.when(F.col("place") + width <= F.size("tokens"), hashed)

    hashes = [of_width(width) for width in widths]
    if len(hashes) == 1:
        return at.select(*keys, hashes[0].alias("hash"))
    return at.select(*keys, F.explode(F.array(*hashes)).alias("hash")).filter("hash is not null")


def kinds_of(width: int) -> tuple[int, ...]:
    return (TYPED, WORDED) if width >= TYPED_TOKENS else (PLAIN,)


def windows(keyed: DataFrame, keys: list[str], widths: list[int]) -> DataFrame:
    """keys, kind, width, place and hash of every window of the rows' ``marked`` text."""
    used = [kind for kind in (TYPED, WORDED, PLAIN) if any(kind in kinds_of(w) for w in widths)]
    # Taken apart twice, so that tokens and templates are columns and not made anew for every window.
    tokens = keyed.select(*keys, F.explode(F.array(as_tokens(F.col("marked")))).alias("values"))
    entry = lambda kind: F.struct(F.lit(kind).alias("kind"), F.transform("values", lambda t: templated(t, kind)).alias("tokens"))
    tokens = tokens.select(*keys, F.inline(F.array(*[entry(kind) for kind in used])))
    parts = []
    for width in widths:
        places = F.sequence(F.lit(1), F.size("tokens") - width + 1)
        window = lambda i: F.struct(  # noqa: B023 (used here only)
            F.lit(width).alias("width"), i.alias("place"), window_hash(F.col("tokens"), i, width).alias("hash")
        )
        fits = F.col("kind").isin(*kinds_of(width)) & (F.size("tokens") >= width)
        parts.append(F.when(fits, F.transform(places, window)).otherwise(F.array().cast("array<struct<width:int,place:int,hash:bigint>>")))
    return tokens.select(*keys, "kind", F.inline(F.concat(*parts)))


def marked_slots(values: Column, place: Column, width: Column) -> Column:
    """The marked values of a window; only placeholders have slots."""
    return F.filter(F.slice(values, place, width), lambda v: v.rlike(f"^[{MARKS}]"))


def with_values(keyed: DataFrame, keys: list[str]) -> DataFrame:
    """keys, kind and the marked values of the rows' ``marked`` text."""
    tokens = keyed.select(*keys, F.explode(F.array(as_tokens(F.col("marked")))).alias("all"))
    entry = lambda k: F.struct(F.lit(k).alias("kind"), F.transform("all", lambda t: valued(t, k)).alias("values"))
    return tokens.select(*keys, F.inline(F.array(*map(entry, (TYPED, WORDED, PLAIN)))))


def item_windows(benchmark: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[int]]:
    """Windows of all items, staged (item, n_windows, kind, width, place, hash, slots, bare), and the widths that occur."""
    text = text_or_empty(text_col)
    inner = F.transform(as_tokens(marked_text(text, INNER_NAMES)), lambda v, k: F.when(v.rlike(f"^[{MARKS}]"), k + 1))
    items = (
        benchmark.select(F.col(id_col).alias("item"), marked_text(text).alias("marked"), F.array_compact(inner).alias("inner"))
        .groupBy("marked")
        .agg(F.min("item").alias("item"), F.min("inner").alias("inner"))
        .withColumn("n_tokens", F.size(as_tokens(F.col("marked"))))
        .filter(F.col("n_tokens") > 0)
        .withColumn("width", F.least(F.lit(WINDOW), F.col("n_tokens")))
        .withColumn("n_windows", F.col("n_tokens") - F.col("width") + 1)
    )
    items = staged(items, "benchmark-items")
    widths = sorted(r.width for r in items.select("width").distinct().collect())  # at most WINDOW values
    keys = ["item", "marked", "n_windows", "inner"]
    parts = [windows(items.filter(F.col("width") == w), keys, [w]) for w in widths]
    if not parts:
        return items, []
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    valued = with_values(items, ["marked"])
    out = out.join(valued, ["marked", "kind"]).withColumn("slots", marked_slots(F.col("values"), F.col("place"), F.col("width")))
    # Windows of words alone: no number, unit or name inside a sentence.
    in_window = lambda k: (k >= F.col("place")) & (k < F.col("place") + F.col("width"))
    bare = (F.col("kind") == PLAIN) | ((F.col("kind") == WORDED) & ~F.exists("inner", in_window))
    return staged(out.withColumn("bare", bare).drop("inner", "marked", "values"), "benchmark-windows"), widths


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Pairs of contaminated document and item: id, ``mark`` (hash of the text), item_id, windows matched."""
    found, widths = item_windows(benchmark, item_id_col, item_text_col)
    text = text_or_empty(text_col)
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    if not widths:
        empty = texts.filter(F.lit(False)).crossJoin(found.select(F.col("item").alias(item_id_col)).limit(0))
        counts = [F.lit(0).cast("long").alias(c) for c in ("matched", "n_windows", "changed")]
        return empty.select(F.col("id").alias(id_col), "mark", item_id_col, *counts)

    # Step 1: which documents share a window. Only ids and hashes take part.
    keys = ["id", "mark"]
    hashes = found.select("hash").distinct()
    if found.count() <= BROADCAST_WINDOWS:
        hashes = F.broadcast(hashes)
    used = sorted({kind for width in widths for kind in kinds_of(width)})
    templates = [as_tokens(without_values(of_kind(F.col("marked"), kind))) for kind in used]
    tokens = texts.select(*keys, marked_text(F.col("text")).alias("marked")).select(*keys, F.explode(F.array(*templates)).alias("tokens"))
    met = window_hashes(tokens, keys, widths).join(hashes, "hash", "left_semi").select(*keys).distinct()
    met = staged(met, "window-hits")

    # Step 2: places and values, for those documents alone, spread by the size of their texts.
    held = staged(matching(texts, met, keys).groupBy(*keys).agg(F.first("text").alias("text")), "window-texts")
    size = held.agg(F.sum(F.octet_length("text")).alias("bytes")).first().bytes or 0
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // TASK_BYTES + 1)
    held = staged(held.repartition(tasks, *keys).select(*keys, marked_text(F.col("text")).alias("marked")), "window-marked")
    # Windows that no item has are gone before slots are compared.
    spread = held.repartition(tasks, *keys)
    theirs = windows(spread, keys, widths).withColumnRenamed("place", "doc_place")
    hits = theirs.join(found, ["kind", "width", "hash"]).withColumn("shift", F.col("doc_place") - F.col("place"))
    valued = with_values(spread, keys).select(F.col("id").alias("of_id"), F.col("mark").alias("of_mark"), F.col("kind").alias("of_kind"), "values")
    own = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("mark") == F.col("of_mark")) & (F.col("kind") == F.col("of_kind"))
    hits = hits.join(valued, own).drop("of_id", "of_mark", "of_kind")
    hits = hits.withColumn("doc_slots", marked_slots(F.col("values"), F.col("doc_place"), F.col("width"))).drop("values")
    pairs = F.flatten(F.collect_set(F.arrays_zip(F.col("slots"), F.col("doc_slots"))))
    aligned = hits.groupBy("id", "mark", "item", "n_windows", "kind", "shift").agg(
        F.collect_set("place").alias("places"),
        F.collect_set(F.when(F.col("bare"), F.col("place"))).alias("plain_places"),
        F.array_distinct(pairs).alias("pairs"),
    )
    n_left = F.size(F.array_distinct(F.col("pairs.slots")))
    n_right = F.size(F.array_distinct(F.col("pairs.doc_slots")))
    consistent = (F.size("pairs") == n_left) & (n_left == n_right)
    changed = F.size(F.filter("pairs", lambda p: p["slots"] != p["doc_slots"]))
    judged = aligned.select(
        "id",
        "mark",
        "item",
        "n_windows",
        F.when(consistent, F.col("places")).otherwise(F.col("plain_places")).alias("places"),
        F.when(consistent, changed).otherwise(F.lit(0)).alias("changed"),
    )
    counted = judged.groupBy("id", "mark", "item", "n_windows").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("matched"), F.max("changed").alias("changed")
    )
    enough = counted.filter(F.col("matched") >= F.least(F.lit(MIN_WINDOWS), F.col("n_windows")))
    return enough.select(
        F.col("id").alias(id_col),
        "mark",
        F.col("item").alias(item_id_col),
        F.col("matched").cast("long").alias("matched"),
        F.col("n_windows").cast("long").alias("n_windows"),
        F.col("changed").cast("long").alias("changed"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of clean documents, with the columns of the input."""
    hits = contaminated(docs, benchmark, id_col, text_col, "item_id", "text")
    gone = staged(hits.select(F.col(id_col).alias("id"), "mark").distinct(), "contaminated")
    return settle(docs, id_col, text_col, gone)
