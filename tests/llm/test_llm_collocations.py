"""Phrase mining against a plain Python version."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import collocations

DOCS = "doc_id long, text string, lang string"


def plain(rows, least, top):
    counts, totals = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        n = totals[lang]
        found = {p: a for p, a in own.items() if a >= least and len(p) > 1}
        kept = []
        for p, a in found.items():
            if any(
                100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in found.items()
                if len(q) > len(p)
            ):
                continue
            score, _, l, r = min((1000 * a * n // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def made(seed, n=250):
    rng = random.Random(seed)
    words = "New york City É über 漢字 the of a a A b\tb x-y \U0001f600 don't end".split(" ")
    text = lambda: "".join(rng.choice(words) + rng.choice((" ", " ", " ", "  ", ". ", ",", "\n", ";\t", "\x0b")) for _ in range(rng.randrange(50)))
    return [(k, text(), rng.choice(("en", "de", None))) for k in range(n)]


EDGES = [
    (1, None, "en"),
    (2, "", "en"),
    (3, "...", "fr"),
    (4, "new york city " * 9000, "en"),
    (5, "w" * 70_000 + " the", "en"),
    (6, "end", "en"),
    (6, "end", "en"),
    (None, "end the", None),
    (7, "the", "und"),
]


@pytest.mark.parametrize("held, size", [(1_500_000, 2 << 20), (40, 300)])
def test_matches_brute_force(spark, monkeypatch, held, size):
    monkeypatch.setattr(collocations, "HELD", held)
    monkeypatch.setattr(collocations, "SLICE", size)
    rows = EDGES + made(1)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    for name in ("k", "fp", "n", "doc", "phrase", "a"):
        docs = docs.withColumn(name, F.lit("x"))
    got = sorted(tuple(r) for r in collocations.collocations(docs, least=12, top=25, bits=1 << 12).collect())
    want = plain(rows, 12, 25)
    assert len(want) > 40
    assert got == want


def test_collisions_are_told_apart(spark):
    """With fingerprints of six bits nearly all phrases collide."""
    rows = made(2, 80)
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted(tuple(r) for r in collocations.collocations(docs, least=5, top=40, bits=1 << 10, fp_mask=63).collect())
    assert got == plain(rows, 5, 40)


def test_a_language_of_most_rows_and_one_hot_phrase(spark):
    rows = [(k, "as you know, the same old words", "en") for k in range(900)] + made(3, 40)
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted(tuple(r) for r in collocations.collocations(docs, least=3, top=2000).collect())
    assert got == plain(rows, 3, 2000)


def test_products_beyond_64_bits(spark, monkeypatch):
    """The score's arithmetic on counts as large as a corpus has them."""
    n, a, l, r = 9 * 10**18, 7 * 10**14 + 1, 8 * 10**14 + 3, 9 * 10**14 + 7
    phrases = spark.createDataFrame([("en", 1, "x", l), ("en", 1, "y", r), ("en", 2, "x y", a)], collocations.PHRASES)
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    monkeypatch.setattr(collocations, "frequent_phrases", lambda *a, **k: (phrases, totals))
    row = collocations.collocations(phrases).first()
    assert row.score == 1000 * a * n // (l * r)


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "one two", "en")], DOCS)
    assert collocations.collocations(df.filter("false")).collect() == []
    assert collocations.collocations(df).collect() == []
