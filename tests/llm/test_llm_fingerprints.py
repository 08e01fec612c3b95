"""Fingerprints against a plain Python version, and their estimates against true likeness."""

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerlake.llm import fingerprints

DOCS = "doc_id long, text string"


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chained(*parts):
    """Spark's hash of several values: the hash so far is the seed of the next."""
    seed = 42
    for p in parts:
        seed = xxhash.xxh64(p, seed=seed).intdigest()
    return seed


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    if not words:
        return set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {(" ".join(words),)}


def plain(text):
    hashes = {signed(chained(*[w.encode() for w in s])) for s in shingles(text)}
    if not hashes:
        return ""
    bins = {}
    for h in hashes:
        bins[h >> 56] = min(h, bins.get(h >> 56, h))
    out = ""
    for i in range(256):
        value = bins.get(i - 128)
        if value is None:
            four = i.to_bytes(4, "little")
            for t in range(fingerprints.PROBES):
                value = bins.get(signed(chained(four, t.to_bytes(4, "little"))) % 256 - 128)
                if value is not None:
                    break
        if value is None:
            value = bins[min(bins, key=lambda b: signed(chained(four, b.to_bytes(8, "little", signed=True))))]
        out += "0123456789abcdef"[value & 15]
    return out


def brute(rows):
    """Rows as (id, text), ordered by id (none first), a hash of the text and the text."""
    key = lambda r: (r[0] is not None, r[0] or 0, signed(chained((r[1] or "").encode())), r[1] or "")
    rows = sorted(rows, key=key)
    out = []
    for k, (i, text) in enumerate(rows):
        text, follow = text or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(text) // 2
        mixed = text[: len(text) - cut] + follow[:cut]
        out.append((i, len(text), hashlib.sha256(mixed.encode()).hexdigest(), plain(text), plain(mixed), plain(follow)))
    return out


def texts(n, seed=5):
    rng = random.Random(seed)
    return [" ".join(rng.choice("aé b Cc dd ee ff gg hh ii 漢字 \U0001f600x kk".split()) for _ in range(rng.randrange(60))) for _ in range(n)]


CASES = [(7, None), (8, ""), (9, " \n "), (10, "one"), (11, "ONE"), (12, "a b c d"), (13, "w " * 30_000), (7, "again"), (7, "again"), (None, "no id"), (None, None), (-4, "before")]


@pytest.mark.parametrize("block_rows", [1, 3, 1000])
def test_matches_brute_force(spark, block_rows):
    rows = CASES + [(20 + 3 * k, t) for k, t in enumerate(texts(60))] + [(500, t) for t in texts(40, 6)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    for name in ("id", "seg", "sub", "tie", "guest", "fp", "next_fp", "to", "first"):
        docs = docs.withColumn(name, F.lit("x"))
    got = fingerprints.edited(docs, block_rows=block_rows).collect()
    want = brute(rows)
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in got), key=key) == sorted(
        (w[:5] for w in want), key=key
    )

    def like(a, b):
        if not a or not b:
            return float(a == b)
        return max(0.0, (sum(x == y for x, y in zip(a, b)) / 256 - 1 / 16) / (15 / 16))

    assert sorted(round(r.near_next, 9) for r in got) == sorted(round(like(w[3], w[5]), 9) for w in want)
    assert sorted(round(r.near_edited, 9) for r in got) == sorted(round(like(w[3], w[4]), 9) for w in want)


def test_many_rows_a_quantile(spark, monkeypatch):
    """With few quantiles, blocks are cut again by the id's value, and a crowd by the text."""
    monkeypatch.setattr(fingerprints, "QUANTILES", 4)
    rows = [(k * k, t) for k, t in enumerate(texts(80))] + [(900, t) for t in texts(60, 9)] + [(None, t) for t in texts(20, 3)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = sorted((str(r.doc_id), r.text, r.next_text) for r in fingerprints.with_next(docs, block_rows=5).collect())
    key = lambda r: (r[0] is not None, r[0] or 0, signed(chained(r[1].encode())), r[1])
    order = sorted(rows, key=key)
    assert got == sorted((str(i), t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order))


def test_one_row_and_none(spark):
    docs = spark.createDataFrame([(3, "a b c d e f")], DOCS)
    row = fingerprints.edited(docs).first()
    assert (row.doc_id, row.n_chars, row.near_next) == (3, 11, 1.0)
    assert row.edited_sha256 == hashlib.sha256(b"a b c a b c"[:6] + b"a b c").hexdigest()
    assert fingerprints.edited(docs.filter("false")).collect() == []


def test_estimates_are_unbiased(spark):
    """Mean error near zero over pairs of every likeness, also of short texts with many empty bins."""
    rng = random.Random(1)
    pairs, true = [], []
    for k in range(400):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice((60, 300, 1500)))]
        other = words[:]
        cut = rng.randrange(len(words))
        other[cut:] = [f"w{rng.randrange(10**6)}" for _ in other[cut:]]
        a, b = shingles(" ".join(words)), shingles(" ".join(other))
        pairs.append((k, " ".join(words), " ".join(other)))
        true.append(len(a & b) / len(a | b))
    df = spark.createDataFrame(pairs, "k long, a string, b string")
    out = df.select("k", fingerprints.likeness(fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("b"))).alias("j"))
    errors = [r.j - true[r.k] for r in out.collect()]
    assert abs(sum(errors) / len(errors)) < 0.006
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.05
