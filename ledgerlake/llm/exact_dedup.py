"""Exact deduplication by progressive refinement.

Rows are grouped by byte length, rows of a repeated length by a hash of their
first characters, and only rows that still share a key get a hash of the whole
text. Texts are equal when they are identical after lower-casing A-Z.

Defined results: a null text counts as empty; of equal texts the largest id
stays; rows that repeat both id and text all carry the id that stays and count
as kept (``drop_exact_copies`` keeps one of them); a null id never beats another
id and stays only if its whole group has none; an empty table gives no rows. Other columns, whatever their names, do not
matter: only the id, the text and ``carry`` are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import ascii_lower, settle, staged, text_or_empty

PREFIX_CHARS = 256


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
    digest_col: str | None = None,
    prefix_chars: int = PREFIX_CHARS,
) -> DataFrame:
    """One row per row: ``row`` (struct of id and carried columns), ``keep_id``, ``group_size``, ``kept``.

    ``digest_col`` names a column that already holds a digest of the normalised
    whole text; without it the whole text is hashed here, for surviving rows only.
    """
    return _grouped(docs, id_col, text_col, carry, digest_col, prefix_chars).drop("content")


def _grouped(
    docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...], digest_col: str | None, prefix_chars: int
) -> DataFrame:
    """The same with ``content``, which rows of a group share."""
    text = ascii_lower(text_or_empty(text_col))
    # The prefix is cut before it is lower-cased, so that only its few characters are touched.
    prefix = F.xxhash64(ascii_lower(F.substring(text_or_empty(text_col), 1, prefix_chars)))
    whole = F.col(digest_col) if digest_col else F.sha2(text.cast("binary"), 256)
    kept_columns = dict.fromkeys([id_col, *carry])
    keyed = docs.select(
        F.struct(*kept_columns).alias("row"),
        F.octet_length(text_or_empty(text_col)).alias("length"),
        prefix.alias("prefix"),
        whole.alias("whole"),
    )
    lengths = keyed.groupBy("length").agg(F.count("*").alias("n")).filter("n > 1").select("length")
    prefixes = (
        keyed.select("length", "prefix")
        .join(staged(lengths, "repeated-lengths"), "length", "left_semi")
        .groupBy("length", "prefix")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .select("length", "prefix", F.lit(True).alias("repeated"))
    )
    # Settled rows get a key of their own: a null key would send them all to one task.
    settled = F.concat_ws(":", F.lit("settled"), "length", "prefix")
    refined = keyed.join(staged(prefixes, "repeated-prefixes"), ["length", "prefix"], "left").select(
        "row",
        F.when(F.col("repeated"), F.concat_ws(":", "length", "whole")).otherwise(settled).alias("content"),
    )
    groups = (
        refined.groupBy("content")
        .agg(F.max(f"row.{id_col}").alias("keep_id"), F.count("*").alias("group_size"))
        .filter("group_size > 1")
    )
    joined = refined.join(staged(groups, "copy-groups"), "content", "left")
    alone = F.col("group_size").isNull()
    keep_id = F.when(alone, F.col(f"row.{id_col}")).otherwise(F.col("keep_id"))
    return joined.select(
        "row",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col(f"row.{id_col}").eqNullSafe(keep_id).alias("kept"),
        "content",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal texts, with the columns of the input.

    It is the one with the largest id; of several rows with that id the one with the least hash of its text, and of
    rows that repeat id and text one. Groups are found with ids and hashes alone; the rows themselves are not shuffled
    but for those in question.
    """
    narrow = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_or_empty(text_col)).alias("mark")
    )
    marked = _grouped(narrow, "id", "text", ("mark",), None, PREFIX_CHARS).filter("group_size > 1")
    marked = staged(marked.select("row.id", "row.mark", "kept", "content"), "copies")
    first = marked.filter("kept").groupBy("content").agg(F.min("mark").alias("first_mark"), F.count("*").alias("n"))
    lasting = marked.filter("kept").join(first, "content")
    gone = marked.filter(~F.col("kept")).select("id", "mark")
    gone = gone.unionByName(lasting.filter("mark <> first_mark").select("id", "mark")).distinct()
    repeated = lasting.filter("n > 1 AND mark = first_mark").select("id", "mark").distinct()
    return settle(docs, id_col, text_col, staged(gone, "copies-gone"), staged(repeated, "copies-repeated"))
