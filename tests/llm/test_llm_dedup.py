"""Exact and near deduplication, and decontamination, against plain Python."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import common, decontaminate, exact_dedup, jaccard_join

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside.
CLASH = "keep_id string, size string, row string, id string, mark string, hi string, kept string, tokens string"


def frame(spark, rows, extra=True):
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).repartition(3)
    if extra:
        for name in CLASH.split(", "):
            df = df.withColumn(name.split()[0], F.lit("x"))
    return df


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


EXACT = [
    (1, "Same Text"),
    (2, "same text"),
    (3, "same texT"),
    (4, None),
    (5, ""),
    (6, "ÀB"),
    (7, "àB"),
    (8, "àb"),
    (9, "x" * 300 + "a"),
    (10, "x" * 300 + "b"),
    (11, "X" * 300 + "A"),
    (12, "w " * 60_000),
    (13, "w " * 60_000),
    (14, "only once"),
    (15, " same text"),
]


@pytest.mark.parametrize("with_digest", [False, True])
def test_exact_dedup(spark, with_digest):
    docs = frame(spark, EXACT)
    name = None
    if with_digest:
        docs = docs.withColumn("d", F.sha2(common.ascii_lower(common.text_or_empty("text")).cast("binary"), 256))
        name = "d"
    got = {
        r.row.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs, digest_col=name).collect()
    }
    groups = {}
    for i, t in EXACT:
        groups.setdefault(lower(t), []).append(i)
    want = {i: (max(g), len(g), i == max(g)) for g in groups.values() for i in g}
    assert got == want


def test_exact_dedup_repeats_and_null_ids(spark):
    docs = frame(spark, [(1, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "b"), (2, "b")], extra=False)
    got = sorted(
        (str(r.row.doc_id), str(r.keep_id), r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs).collect()
    )
    assert got == [
        ("1", "1", 3, True),
        ("1", "1", 3, True),
        ("2", "2", 3, True),
        ("None", "1", 3, False),
        ("None", "2", 3, False),
        ("None", "2", 3, False),
    ]


def test_drop_exact_copies_keeps_columns(spark):
    docs = frame(spark, EXACT)
    out = exact_dedup.drop_exact_copies(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == [3, 5, 6, 8, 10, 11, 13, 14, 15]
    assert exact_dedup.drop_exact_copies(docs.filter("false")).count() == 0


# --- similarity join ---


def shingle_set(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute_classes(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    links = {i: set() for i in sets}
    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            links[a].add(b)
            links[b].add(a)
    label = dict.fromkeys(sets)
    for i in sorted(sets):
        todo = [i]
        while todo:
            at = todo.pop()
            if label[at] is None:
                label[at] = i
                todo += links[at]
    return {i: (label[i], len(links[i]), len({sets[j] for j in links[i]} - {sets[i]}), label[i] == i) for i in sets}


def near_rows(n_groups=12, size=10, seed=3):
    rng = random.Random(seed)
    rows, i = [], 0
    for _ in range(n_groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(60, 160))]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randrange(0, 5)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(400)}"
            rows.append((i, " ".join(words)))
            i += 1
    return rows


@pytest.mark.parametrize("blocks", [1024, 7])
def test_classes_and_links_match_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", blocks)  # small blocks: pairs of blocks are compared apart
    monkeypatch.setattr(jaccard_join, "SMALL", 4)  # and nodes are split further
    rows = near_rows() + [(500, None), (501, ""), (502, "one two"), (503, "ONE  two"), (504, "one two three"), (505, "a " * 30_000)]
    got = {
        r.doc_id: (r.class_id, r.n_links, r.n_linked_texts, r.kept)
        for r in jaccard_join.similar_classes(frame(spark, rows)).collect()
    }
    assert got == brute_classes(rows)


def test_pairs_of_a_block_are_compared_in_strips():
    """Of all pairs of a block's sets only booleans stand in memory; results are those of plain Python."""
    import tracemalloc

    rng = np.random.default_rng(4)
    common_part = rng.integers(0, 2**63, 50, dtype=np.uint64)
    sets = [np.unique(np.append(common_part, rng.integers(0, 2**63, k % 25, dtype=np.uint64))) for k in range(1200)]
    tracemalloc.start()
    similar = jaccard_join.exactly_similar(sets, 0.8)
    edges = jaccard_join.spanning(similar)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * len(sets) ** 2  # less than one matrix of numbers
    plain = [set(s.tolist()) for s in sets[:60]]
    want = [[len(a & b) >= 0.8 * len(a | b) for b in plain] for a in plain]
    assert similar[:60, :60].tolist() == want and (similar == similar.T).all()
    assert len(edges) == sum(similar.sum(axis=1) > 1) - 1  # those at 0.8 to some other are one component


def test_large_group_of_near_copies(spark):
    rng = random.Random(1)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(400):
        words = list(base)
        words[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(words)))
    got = jaccard_join.similar_classes(frame(spark, rows, extra=False)).collect()
    want = brute_classes(rows)
    assert {r.doc_id: r.class_id for r in got} == {i: w[0] for i, w in want.items()}
    assert all(r.n_links <= want[r.doc_id][1] for r in got)
    assert sum(r.n_links for r in got) >= jaccard_join.TARGET * sum(w[1] for w in want.values())


def test_near_copies_repeated_rows_null_ids_and_empty_table(spark):
    text = " ".join(f"w{k}" for k in range(40))
    docs = frame(spark, [(5, text), (5, text), (None, text), (None, None), (6, text + " more")])
    got = sorted((str(r.doc_id), str(r.class_id), r.n_links, r.kept) for r in jaccard_join.similar_classes(docs).collect())
    assert got == [("5", "5", 3, True), ("5", "5", 3, True), ("6", "5", 3, False), ("None", "5", 3, False), ("None", "None", 0, True)]
    out = jaccard_join.keep_one_per_class(docs.filter("doc_id is not null"))
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {5}
    assert jaccard_join.similar_classes(docs.filter("false")).count() == 0


def test_links_of_few_long_copies_count_once(spark, monkeypatch):
    """Groups of few sets in several blocks leave some blocks empty."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 100)  # two blocks for two sets
    texts = [" ".join(f"g{g}w{k}" for k in range(100)) for g in range(40)]
    rows = [(2 * g + k, text + k * " more") for g, text in enumerate(texts) for k in range(2)]
    got = {r.doc_id: r.n_links for r in jaccard_join.similar_classes(frame(spark, rows, extra=False)).collect()}
    assert got == {i: w[1] for i, w in brute_classes(rows).items()}


def test_clean_text_under_the_id_of_a_near_copy_stays(spark):
    text = " ".join(f"w{k}" for k in range(40))
    docs = frame(spark, [(1, text), (5, text + " more"), (5, "another text of its own"), (None, text), (None, "and one more text")])
    out = jaccard_join.keep_one_per_class(docs)
    assert out.columns == docs.columns
    kept = {(1, text), (5, "another text of its own"), (None, "and one more text")}
    assert {(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()} == kept


def test_runs_reach_the_target():
    assert jaccard_join.runs_needed(target=0.9) < jaccard_join.runs_needed(target=0.999)


# --- decontamination ---

ITEM = "A shop sells 12 red apples and 5 pears to Tom before noon. How many fruits are sold if each of the 12 apples weighs 3 kg today?"
ITEMS = [
    (1, ITEM),
    (2, "the quick brown fox jumps over the lazy dog and then sleeps for a very long while near home"),
    (3, None),
    (4, "too short"),
    (5, "six words make one short item"),
    (6, ITEM),
]
FILLER = "plain filler words stand here and say nothing at all of note to anybody who reads them"


def leaks(spark, rows, items=ITEMS):
    docs = frame(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("mark", F.lit(1)).withColumn("doc_id", F.lit(7))
    found = decontaminate.contaminated(docs, bench)
    return docs, bench, {(r.doc_id, r.item_id): (r.matched, r.n_windows, r.changed) for r in found.collect()}


def test_leaks_with_changed_values(spark):
    renamed = ITEM.replace("12", "40").replace("5", "7").replace("Tom", "Anna").replace("3 kg", "8 lb")
    half = ITEM.replace("12", "40", 1)  # one of the two 12s only: not the same question
    rows = [
        (1, f"{FILLER}. {ITEM} {FILLER}"),
        (2, f"{FILLER}. {ITEM.replace('12', '40').replace('5', '7').replace('Tom', 'Anna')} {FILLER}"),
        (3, f"{FILLER}. {half}"),
        (4, FILLER),
        (5, None),
        (6, ""),
        (7, f"{FILLER} {ITEMS[1][1].upper()} {FILLER}"),
        (8, f"{FILLER} six words make one short item {FILLER}"),
        (9, "too short"),
        (10, " ".join(ITEMS[1][1].split()[:9])),
        (11, (FILLER + " ") * 1500 + ITEMS[1][1]),
        (12, f"{FILLER}. {renamed}"),
    ]
    _, _, found = leaks(spark, rows)
    assert set(found) >= {(1, 1), (2, 1), (7, 2), (8, 5), (9, 4), (11, 2)}
    assert not {i for i, _ in found} & {3, 4, 5, 6, 10}
    assert found[1, 1][2] == 0 and found[2, 1][2] == 3
    assert all(item != 6 for _, item in found)  # the same item again is searched as its first


def test_leaks_wherever_the_item_stands(spark):
    """What stands before a copy, or its case, does not matter."""
    boiling = "What is the boiling point of water at sea level?"
    river = "Which river flows through Paris and then meets the Channel near Havre before it ends?"
    rows = [
        (1, f"Exercise 4\n{boiling}"),
        (2, f"as the quiz asks, {boiling} {FILLER}"),
        (3, f"{FILLER} {river.lower()} {FILLER}"),
        (4, f"{FILLER}. {river}"),
        (5, f"exercise 4, {river.replace('Paris', 'Rouen')}"),
        (6, f"{FILLER} {river.upper()}"),
        (7, f"Part 2\n{boiling.replace('water', 'mercury')}"),
        (8, f"{FILLER}, Days pass on earth while sun and moon go round it"),
        (9, "he counted 3 Days pass on earth while sun and moon go round it"),
    ]
    items = [(1, boiling), (2, river), (3, "Days pass on earth while sun and moon")]
    _, _, found = leaks(spark, rows, items)
    assert set(found) == {(1, 1), (2, 1), (3, 2), (4, 2), (5, 2), (6, 2), (8, 3), (9, 3)}
    assert found[5, 2][2] == 1


def test_short_items_match_word_by_word(spark):
    items = [(1, "capital of France"), (2, "Yes"), (3, "in 1815"), (4, "3 kg of iron"), (5, "one two"), (6, "!!!")]
    rows = [
        (1, f"{FILLER}. Name the Capital of France, if you can"),
        (2, f"{FILLER} the capital of Spain is far away"),
        (3, f"{FILLER}: YES! he said in 1815, then he left"),
        (4, "yesterday in 1816 he left with 3 kg of tin"),
        (5, "3 kg of iron"),
        (6, "he bought 3kg of iron. One, two."),
        (7, "capital capital of france france"),
        (8, "capital of of France"),
    ]
    _, _, found = leaks(spark, rows, items)
    assert set(found) == {(1, 1), (3, 2), (3, 3), (5, 4), (6, 4), (6, 5), (7, 1)}


def test_windows_of_placeholders_alone(spark):
    """A row of numbers is found where its values stand for each other one to one."""
    items = [(1, "12 14 16 18 20 22 24 26"), (2, ITEM)]
    rows = [(1, "row 3 5 7 9 11 13 15 17 end"), (2, "1 1 2 2 3 3 4 4"), (3, ITEM), (4, FILLER)]
    _, _, found = leaks(spark, rows, items)
    assert set(found) == {(1, 1), (3, 2)}


def test_repeats_and_similar_texts_under_one_id_go(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(1, text), (1, text), (1, text + " more"), (2, "Other"), (2, "other"), (3, None), (3, None), (4, "alone"), (4, "two alone")]
    docs = frame(spark, rows)
    out = exact_dedup.drop_exact_copies(docs)
    kept = sorted((r.doc_id, str(r.text)) for r in out.collect())
    assert out.columns == docs.columns and kept[:3] == [(1, text), (1, text + " more"), (2, kept[2][1])]
    assert kept[3:] == [(3, "None"), (4, "alone"), (4, "two alone")]
    left = [(r.doc_id, r.text) for r in jaccard_join.keep_one_per_class(docs).collect()]
    assert len([1 for i, _ in left if i == 1]) == 1 and len([1 for i, _ in left if i == 2]) == 1
    assert sorted(str(x) for x in left if x[0] > 2) == ["(3, None)", "(3, None)", "(4, 'alone')", "(4, 'two alone')"]


def test_clean_rows_stay_whole(spark):
    rows = [(1, ITEM), (2, FILLER), (2, FILLER), (None, FILLER), (None, ITEM), (3, None)]
    docs, bench, _ = leaks(spark, rows)
    out = decontaminate.drop_contaminated(docs, bench)
    assert out.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in out.select("doc_id", "text").collect() if r.text) == [
        ("2", FILLER),
        ("2", FILLER),
        ("None", FILLER),
    ]
    assert decontaminate.drop_contaminated(docs, bench.filter("false")).count() == len(rows)
    assert decontaminate.contaminated(docs.filter("false"), bench).count() == 0


def test_windows_match_brute_force_on_given_tables(spark, sf_dir):
    """On tables without numbers a leak is a run of equal lower-case words."""
    import re

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    plain = lambda t: [w for w in re.sub(r"[^\w\s]|_", "", t.lower()).split() if w]
    windows, sizes = {}, {}
    for r in bench.collect():
        w = plain(r.text)
        sizes[r.item_id] = len(w) - 7
        for k in range(len(w) - 7):
            windows.setdefault(tuple(w[k : k + 8]), []).append((r.item_id, k))
    want = {}
    for r in docs.collect():
        w = plain(r.text or "")
        met = {}
        for k in range(len(w) - 7):
            for item, place in windows.get(tuple(w[k : k + 8]), ()):
                met.setdefault(item, set()).add(place)
        want |= {(r.doc_id, i): len(p) for i, p in met.items() if len(p) >= min(6, sizes[i])}
    got = {(r.doc_id, r.item_id): r.matched for r in decontaminate.contaminated(docs, bench).collect()}
    assert set(got) == set(want)


def test_digest_of_query(spark, sf_dir):
    from ledgerlake.llm.queries import op2_exact_dedup

    rows = op2_exact_dedup(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    assert all(r.text_sha256 == hashlib.sha256(lower(texts[r.doc_id]).encode()).hexdigest() for r in rows)


def test_window_rows_hash_like_slices(spark):
    """Windows made as rows have the hashes of the items' windows, for every width and up to the last token."""
    from pyspark.sql import functions as F

    words = [[], ["a"], list("abc"), [f"w{k % 5}" for k in range(20)], ["\ue000", "of", "\ue001"]]
    rows = spark.createDataFrame(list(enumerate(words)), "k int, tokens array<string>")
    for widths in ([8], [3], [1, 2, 3, 8]):
        got = sorted(tuple(r) for r in decontaminate.window_hashes(rows, ["k"], widths).collect())
        cut = [(k, t[i : i + w]) for k, t in enumerate(words) for w in widths for i in range(len(t) - w + 1)]
        frame = spark.createDataFrame(cut, "k int, tokens array<string>")
        want = frame.select("k", decontaminate.window_hash(F.col("tokens"), F.lit(1), F.size("tokens")))
        assert got == sorted(tuple(r) for r in want.collect())
