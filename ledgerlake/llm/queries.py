"""The registered queries of this folder, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (
    class_lm,
    collocations,
    decontaminate,
    exact_dedup,
    fingerprints,
    html_text,
    jaccard_join,
    language_id,
    licenses,
    packing,
    toxicity,
    turn_trie,
    warc_zip,
)
from ledgerlake.llm.common import ascii_lower, fold, text_or_empty

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts. The contract wants a digest of every row, so it is taken in the scan."""
    digest = F.sha2(ascii_lower(text_or_empty("text")).cast("binary"), 256)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", digest.alias("text_sha256"))
    marked = exact_dedup.exact_dedup(docs, carry=("text_sha256",), digest_col="text_sha256")
    return marked.select("row.doc_id", "keep_id", "group_size", "kept", "row.text_sha256")


ORACLES["op2_exact_dedup"] = """
WITH digests AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents),
groups AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM digests GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, coalesce(d.doc_id = g.keep_id, false) AS kept, d.text_sha256
FROM digests d JOIN groups g ON d.text_sha256 = g.text_sha256
"""


@register
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    labelled = language_id.sample(docs.filter(fold("doc_id", 3) != 1), "text", "lang")
    marked = language_id.identify(docs, labelled).select("row.doc_id", "lang_pred", "score")
    return marked.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@register
def op5_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under the class model of the rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, scores = class_lm.train_and_score(docs, fold("doc_id", 7) != 2)
    return scores.select(
        "doc_id",
        (fold("doc_id", 7) == 2).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


@register
def op9_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through packed archives and back."""
    return warc_zip.round_trip(table(spark, sf_dir, "pages"), payload=False)


ORACLES["op9_warc_zip"] = """
WITH payloads AS (
  SELECT page_id, url, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex
  FROM pages),
fives AS (
  SELECT *, list_transform(range(0, 40, 5), lambda i: CAST('0x' || substr(hex, CAST(i + 1 AS INT), 5) AS INT)) AS parts
  FROM payloads),
digests AS (
  SELECT page_id, url, payload_bytes,
    array_to_string(list_transform(parts, lambda v:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 15) % 32 + 1, 1) ||
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 10) % 32 + 1, 1) ||
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 5) % 32 + 1, 1) ||
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v % 32 + 1, 1)), '') AS payload_digest
  FROM fives),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM digests)
SELECT page_id, url, payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM firsts
"""


@register
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages, with the items."""
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("mark")


@register
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and link counts of near-equal documents."""
    return jaccard_join.similar_classes(table(spark, sf_dir, "documents"))


ORACLES["op1_jaccard_join"] = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\\s+'), lambda w: w <> '') AS w FROM documents),
shingles AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE
    list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
sets AS (SELECT min(doc_id) AS first_id, count(*) AS copies, list_sort(s) AS s FROM shingles WHERE len(s) > 0 GROUP BY list_sort(s)),
items AS (SELECT first_id, copies, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.first_id AS a, b.first_id AS b, any_value(b.copies) AS copies FROM items a JOIN items b ON a.x = b.x AND a.first_id <> b.first_id
  GROUP BY a.first_id, b.first_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9),
reach(v, r) AS (SELECT a, b FROM links UNION SELECT reach.v, links.b FROM reach JOIN links ON reach.r = links.a),
class_of AS (SELECT v, least(min(r), v) AS class_id FROM reach GROUP BY v),
totals AS (SELECT a, sum(copies) AS linked, count(*) AS texts FROM links GROUP BY a),
every AS (
  SELECT s.doc_id, coalesce(c.class_id, e.first_id, s.doc_id) AS class_id,
    CAST(coalesce(e.copies - 1, 0) + coalesce(t.linked, 0) AS BIGINT) AS n_links,
    CAST(coalesce(t.texts, 0) AS BIGINT) AS n_linked_texts
  FROM shingles s LEFT JOIN sets e ON list_sort(s.s) = e.s
  LEFT JOIN class_of c ON c.v = e.first_id LEFT JOIN totals t ON t.a = e.first_id)
SELECT *, doc_id = class_id AS kept FROM every
"""


@register
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces in sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents; a document's path is source, language and id."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path")
    )
    found = licenses.scan(docs, "path", "text", ("doc_id",))
    return found.select("row.doc_id", "path", "license", "similarity", "origin", "from_dir")


@register
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.learn(*toxicity.sample(docs, labels.filter(fold("doc_id", 4) != 2)))
    marked = toxicity.score(docs, model).select("row.doc_id", "score")
    return marked.select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@register
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select("row.page_id", "row.url", "text", F.char_length("text").cast("long").alias("n_chars"))


@register
def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints.edited(table(spark, sf_dir, "documents"))


@register
def op12_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    return turn_trie.trie(table(spark, sf_dir, "conversations"))


ORACLES["op12_turn_trie"] = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST,
    substr(sha256(concat(strlen(role), ':', role, text)), 1, 32)) AS x FROM turns GROUP BY conv_id),
heads AS (
  SELECT conv_id, x, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
      lambda s, z: xor(s >> 1, 3988292384 * (s & 1)))), 4294967295) % 9 AS h FROM own),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(list_slice(b.x, 1, o.h), []), list_slice(o.x, o.h + 1, len(o.x))) AS x
  FROM heads o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
starts AS (SELECT conv_id, x, unnest(range(0, len(x) + 1)) AS d FROM rebuilt),
nodes AS (
  SELECT d, list_slice(x, 1, d) AS p, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(x) = d), '') AS ends
  FROM starts GROUP BY ALL),
kids AS (SELECT d - 1 AS d, list_slice(p, 1, d - 1) AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
own_values AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children, CASE WHEN n.d = 0 THEN 0 ELSE (n.n_convs - 1) * strlen(n.p[n.d].text) END AS saved
  FROM nodes n LEFT JOIN kids k ON n.d = k.d AND n.p = k.p),
upwards AS (
  SELECT a AS d, list_slice(p, 1, a) AS p, CAST(n_children = 0 AS BIGINT) AS leaf, saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM own_values)),
sums AS (SELECT d, p, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM upwards GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM own_values n JOIN sums s ON n.d = s.d AND n.p = s.p LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = list_slice(n.p, 1, n.d - 1)
"""


@register
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op13_collocations"] = """
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM words, (SELECT unnest([1, 2, 3, 4, 5]) AS k)),
counts AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND a >= 100),
cuts AS (
  SELECT *, array_to_string(w[1:cut], ' ') AS left_part, array_to_string(w[cut + 1:k], ' ') AS right_part
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)),
scored AS (
  SELECT c.lang, c.phrase, c.k, c.a, cut, x.a AS l, y.a AS r, t.n, CAST((1000::HUGEINT * c.a * t.n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = left_part JOIN counts y ON y.lang = c.lang AND y.phrase = right_part
  JOIN totals t ON t.lang = c.lang),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_phrases AS (
  SELECT lang, a, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, k - size + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS size FROM candidates))),
around AS (SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY ALL),
kept AS (
  SELECT w.* FROM worst w LEFT JOIN around o ON o.lang = w.lang AND o.phrase = w.phrase WHERE o.longer IS NULL OR 100 * o.longer < 100 * w.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
