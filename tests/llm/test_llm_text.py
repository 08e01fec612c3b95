"""Language identification, language model, toxicity, page text and licences."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import class_lm, html_text, language_id, licenses, queries, toxicity

DOCS = "doc_id long, text string"


def clashing(df):
    for name in ("row", "lang_pred", "score", "word", "n", "mark", "id", "template", "file"):
        df = df.withColumn(name, F.lit("x"))
    return df


# --- language ---

LABELLED = [
    ("en", "the cat sat on the mat and the dog ran over the hill with them"),
    ("de", "der hund lief über den berg und die katze schlief auf der matte"),
    ("fr", "le chien courait sur la colline et le chat dormait sur le tapis"),
]


def longest(text, start, source):
    n = 0
    while start + n < len(text) and text[start : start + n + 1] in source:
        n += 1
    return n


def test_phrases_match_brute_force():
    parser = language_id.Parser(LABELLED)
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdehilnorstu ") for _ in range(rng.randrange(1, 200))) for _ in range(40)]
    texts += [t for _, t in LABELLED]
    coded = [parser.symbols_of_codes(language_id.letter_codes(" " + t)) for t in texts]
    costs = parser.costs(coded)
    for k, lang in enumerate(parser.langs):
        source = parser.symbols_of_codes(language_id.letter_codes(" " + dict(LABELLED)[lang])).tobytes()
        for row, text in zip(costs, coded):
            text, at, phrases = text.tobytes(), 0, 0
            while at < len(text):
                at += max(1, longest(text, at, source))
                phrases += 1
            assert math.isclose(row[k], phrases * math.log2(len(source)) / len(text))


def test_language_tables_are_built_in_place():
    """Beside the tables that are done stands one automaton, and no copies of it."""
    import tracemalloc

    rng = random.Random(5)
    labelled = [(lang, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=20_000))) for lang in ("aa", "bb")]
    tracemalloc.start()
    parser = language_id.Parser(labelled)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    whole = (2 * 20_000 + 2) * language_id.SYMBOLS * 4  # what an automaton asks for, filled or not
    assert len(parser.tables) == 2 and peak < 3 * whole


def test_workers_let_the_last_model_go(spark):
    from ledgerlake.llm import common

    narrow = spark.range(4).repartition(1)

    def keep(batches):
        for part in batches:
            yield common.held("table", lambda: part)

    def count(batches):
        for part in batches:
            yield part.slice(0, len(common._HELD))

    assert common.in_tasks(narrow, keep, "id long", holds=True).count() == 4
    assert common.in_tasks(narrow, count, "id long").count() == 0


def test_memory_of_the_last_model_goes_back():
    """Also where something that is still used lies behind it."""
    import os

    from ledgerlake.llm import common

    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")

    common.held("blocks", lambda: [b"x" * 50_000 for _ in range(2000)])
    behind = b"y" * 50_000
    full = resident()
    common.let_go()
    assert behind and full - resident() > 80_000_000


def test_workers_get_small_batches(spark):
    """Rows go to Python in small batches, whatever the session's own setting; a smaller one stays."""
    from ledgerlake import session
    from ledgerlake.llm import common

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def sizes(batches):
        for part in batches:
            yield pa.RecordBatch.from_arrays([pa.array([part.num_rows])], ["id"])

    def largest():
        return common.in_tasks(spark.range(0, 5000, 1, 1), sizes, "id long").agg(F.max("id")).first()[0]

    try:
        spark.conf.set(name, "10000")
        assert largest() == session.BATCH_ROWS
        spark.conf.set(name, "100")
        assert largest() == 100
    finally:
        spark.conf.unset(name)


def test_language_edge_cases(spark):
    rows = [(1, "the dog and the cat"), (2, None), (3, ""), (4, "123 !?"), (5, "der hund und die katze"), (6, "the " * 40_000), (1, "the dog and the cat")]
    docs = clashing(spark.createDataFrame(rows, DOCS))
    got = sorted((r.row.doc_id, r.lang_pred, r.score) for r in language_id.identify(docs, LABELLED).collect())
    assert [g[:2] for g in got] == [(1, "en"), (1, "en"), (2, "und"), (3, "und"), (4, "und"), (5, "de"), (6, "en")]
    assert all(0 <= g[2] <= 1 for g in got) and got[0] == got[1] and got[2][2] == 0
    assert {r.lang_pred for r in language_id.identify(docs, []).collect()} == {"und"}
    assert language_id.identify(docs.filter("false"), LABELLED).count() == 0
    kept = language_id.keep_identified(docs, LABELLED)
    assert kept.columns == docs.columns and kept.count() == 4


def test_scripts_beside_each_other():
    """Letters beyond the common ones are spelled out, not thrown together."""
    labelled = [
        ("zh", "我们学习历史和科学，世界经济正在发展。学生在学校学习语言和文化，老师讲课。" * 3),
        ("ja", "私たちは歴史を学びます。世界の経済は発展しています。学生は学校で言葉と文化を勉強します。" * 3),
        ("el", "η γάτα κάθισε στο χαλί και ο σκύλος έτρεξε"),
        ("ru", "кошка сидела на ковре а собака бежала через холм"),
        *LABELLED,
    ]
    parser = language_id.Parser(labelled)
    texts = ["我们学习历史", "世界经济", "学生は言葉", "собака бежала", "der hund und die katze", "σκύλος"]
    langs, scores = parser.identify(texts)
    assert langs == ["zh", "zh", "ja", "ru", "de", "el"] and min(scores) > 0.2
    every = np.arange(0x20, 0xD7FF)
    letters = every[language_id._LETTERS[every]]
    spelled = [parser.symbols_of_codes(np.array([c])).tobytes() for c in letters]
    assert len(set(spelled)) == len(letters)


def test_training_texts_stay_whole(spark):
    rows = [(k, "wort " * n) for k, n in enumerate((10, 50, 399, 3000))]
    labelled = spark.createDataFrame(rows, DOCS).withColumn("lang", F.lit("de"))
    taken = [len(t) for _, t in language_id.sample(labelled, "text", "lang")]
    assert sorted(taken[:3]) == [50, 250, 1995] and taken[3] == 15_000


def test_language_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    got = queries.op7_language_id(spark, sf_dir).filter("held_out").join(docs, "doc_id")
    right, total = got.filter("lang = lang_pred").count(), got.count()
    assert total > 30 and right / total > 0.95


# --- language model ---


def test_base_scores_match_brute_force(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    split = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()) + [None]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    counts = Counter(w for i, t in docs.items() if not held[i] for w in split(t))
    n, v = sum(counts.values()), len(counts)
    got = queries.op5_class_lm(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        row = split(docs[r.doc_id])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(row), n)
        assert r.n_known == sum(counts[w] > 0 for w in row)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in row), rel_tol=1e-9)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_model_is_a_distribution(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "HOT", 5)  # most words take the join
    rows = [(i, " ".join(random.Random(i).choices(["aa", "bb", "cc", "dd", "ee", "ff", "gg"], k=30))) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    model = class_lm.train(docs)
    np.testing.assert_allclose((10**model.transition).sum(axis=1), 1)
    vocabulary = {r.word: (r.n, r["class"]) for r in model.vocabulary.collect()}
    mass = Counter({model.unknown_class: 10**model.unknown})
    for n, cls in vocabulary.values():
        mass[cls] += n * 10 ** model.known[cls]
    np.testing.assert_allclose([*mass.values()], 1)

    def by_hand(text):
        before, total = class_lm.END_CLASS, 0.0
        for word in class_lm.words(text):
            n, cls = vocabulary.get(word.decode(), (0, model.unknown_class))
            total += model.transition[before, cls] + (math.log10(n) + model.known[cls] if n else model.unknown)
            before = cls
        return total + model.transition[before, class_lm.END_CLASS]

    tests = clashing(spark.createDataFrame([(1, "aa bb new cc new"), (2, None), (3, rows[0][1]), (3, rows[0][1]), (None, "AA\x0bzz x")], DOCS))
    got = class_lm.score(tests, model).collect()
    assert len(got) == 5
    texts = {1: "aa bb new cc new", 2: "", 3: rows[0][1], None: "aa\x0bzz x"}
    for r in got:
        assert math.isclose(r.score, by_hand(texts[r.doc_id]), rel_tol=1e-9)


def test_transitions_count_every_word(spark, monkeypatch):
    """Words beyond the hot ones take part in the transitions, also side by side and in rows that repeat."""
    monkeypatch.setattr(class_lm, "HOT", 3)
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices([f"w{k}" for k in range(40)], k=rng.randrange(25)))) for i in range(60)]
    rows += [rows[0], rows[1], (None, rows[2][1]), (7, None)]
    model = class_lm.train(spark.createDataFrame(rows, DOCS).repartition(3))
    cls = {r.word.encode(): r["class"] for r in model.vocabulary.collect()}
    assert len(cls) == 40 and len(model.hot) == 3
    table = np.zeros((class_lm.SIDES, class_lm.SIDES))
    for _, text in rows:
        path = [class_lm.END_CLASS, *(cls[w] for w in class_lm.words(text)), class_lm.END_CLASS]
        np.add.at(table, (path[:-1], path[1:]), 1)
    size = table.sum(axis=0)
    share = (size + 1) / (size.sum() + class_lm.SIDES)
    np.testing.assert_allclose(10**model.transition, (table + share) / (table.sum(axis=1, keepdims=True) + 1))


def test_model_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], DOCS)
    model = class_lm.train(docs.filter("false"))
    got = class_lm.score(docs, model).collect()
    assert [(r.n_known, r.base_score) for r in got] == [(0, 0.0), (0, 0.0)] and all(math.isfinite(r.score) for r in got)
    assert class_lm.score(docs.filter("false"), model).count() == 0


def test_every_word_gets_a_learned_class(spark, monkeypatch):
    """Words far below the frequent ones go to the class whose places they take; rounds raise the likelihood."""
    monkeypatch.setattr(class_lm, "FREQUENT", 12)
    monkeypatch.setattr(class_lm, "UNITS", 13)
    monkeypatch.setattr(class_lm, "FLUSH", 50)  # tasks hand on often
    rng = random.Random(3)
    nouns, verbs = [f"n{k}" for k in range(6)], [f"v{k}" for k in range(6)]
    rare = {f"rn{k}": nouns for k in range(40)} | {f"rv{k}": verbs for k in range(40)}
    rows, pending = [], [w for w in rare for _ in range(4)]
    rng.shuffle(pending)
    for i in range(400):
        text = [rng.choice(kind) for _ in range(8) for kind in (nouns, verbs)]
        if i < len(pending):  # a rare noun or verb in place of a frequent one
            places = [k for k, w in enumerate(text) if w in rare[pending[i]]]
            text[rng.choice(places[1:-1])] = pending[i]
        rows.append((i, " ".join(text)))
    rows.append((999, "alone"))
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    cls = {r.word: (r.n, r["class"]) for r in class_lm.train(docs).vocabulary.collect()}
    counts = Counter(w for _, t in rows for w in t.split())
    assert {w: n for w, (n, _) in cls.items()} == counts
    noun_classes, verb_classes = ({cls[w][1] for w in kind} for kind in (nouns, verbs))
    assert not noun_classes & verb_classes
    assert {cls[w][1] for w in rare if w in cls and w[1] == "n"} <= noun_classes
    assert {cls[w][1] for w in rare if w in cls and w[1] == "v"} <= verb_classes


def test_exchange_separates_two_alternating_classes():
    bigrams = np.zeros((class_lm.UNITS, class_lm.UNITS))
    rng = np.random.default_rng(0)
    left, right = np.arange(0, 60), np.arange(60, 120)
    for a in left:
        for b in right:
            bigrams[a, b], bigrams[b, a] = rng.integers(5, 9), rng.integers(5, 9)
    member = class_lm.exchange(bigrams)
    assert not set(member[left]) & set(member[right])


# --- toxicity ---

MODEL = toxicity.ToxicityModel({"idiot": 5.0, "moron": 5.0}, 2.0, -4.0)


@pytest.mark.parametrize(
    "more, less",
    [
        ("you are an idiot", "some idiot walked by"),
        ("you idiot", "you are not an idiot"),
        ("you idiot", "he said you idiot"),
        ("kill you idiot", "you idiot"),
        ("idiot moron", "idiot and also then a moron"),
        ("i will not. you idiot", "i will not call you idiot"),
    ],
)
def test_grammar_orders_clauses(more, less):
    assert MODEL.total(more) > MODEL.total(less) > 0


def test_composition_is_one_after_the_other():
    rng = random.Random(0)
    parts = [toxicity.negation(), toxicity.reported(), toxicity.target(), toxicity.insult(), toxicity.threat()]
    whole = toxicity.grammar()
    for _ in range(200):
        row = [rng.randrange(toxicity.CLASSES) for _ in range(12)]
        states, state = [p.start for p in parts], whole.start
        for read in row:
            factor, symbol = 1.0, read
            for k, part in enumerate(parts):
                states[k], symbol, more = part.arcs[states[k], symbol]
                factor *= more
            state, write, got = whole.arcs[state, read]
            assert write == symbol and math.isclose(got, factor)


def test_toxicity_edge_cases(spark):
    rows = [(1, "you idiot"), (2, None), (3, ""), (4, "fine words"), (5, "word " * 30_000 + "you idiot"), (1, "you idiot")]
    docs = clashing(spark.createDataFrame(rows, DOCS))
    got = {}
    for r in toxicity.score(docs, MODEL).collect():
        got.setdefault(r.row.doc_id, set()).add(round(r.score, 9))
    assert all(len(v) == 1 for v in got.values()) and got[1] == got[5] and got[2] == got[3] == got[4]
    assert toxicity.score(docs.filter("false"), MODEL).count() == 0
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    texts, marks, share = toxicity.sample(docs, labels)
    assert (texts, marks, share) == (["you idiot"], [1], 1.0)
    assert toxicity.learn([], [], 0.0).score("x") < 0.01


def test_toxicity_held_out(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    got = queries.op6_toxicity(spark, sf_dir).filter("held_out").join(labels, "doc_id").collect()
    assert got and sum((r.score >= 0.3) == r.predicted for r in got) == len(got)
    assert sum(r.predicted == r.toxic for r in got) / len(got) > 0.75


# --- pages ---

TREE = html_text.train()


def test_labelled_table_is_learned():
    for page, main in html_text.LABELLED:
        found = html_text.blocks(page)
        assert {k for k, keep in enumerate(TREE.decide(html_text.features(found))) if keep} == main


def test_page_text():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
    <header class="site"><p>Site</p></header><nav><a href="/">Home</a></nav><div class="cookie-notice"><p>We use cookies.</p></div>
    <article><header><h1>Head &amp; tail</h1></header><p>One <b>bold</b>   word&nbsp;here.<br>Next &lt;p&gt; line &copy 2020</p>
    <div class="ad-box ad"><p>Buy now</p></div><!-- no --><p>Last<p>Unclosed <i>tag
    <section id="comments"><p>Nice!</p></section></article><aside><p>More</p></aside><form><p>Mail</p><input></form><footer>End</footer>"""
    assert html_text.main_text(page, TREE) == "Head & tail\n\nOne bold word here. Next <p> line © 2020\n\nLast\n\nUnclosed tag"


def test_pages_edge_cases(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<article><p>a</p>"), (3, "u", "<article><p>a</p>"), (4, "u", "<<<"), (5, "u", "<article>" + "<p>w</p>" * 20_000)]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string")).withColumn("text", F.lit("x"))
    got = sorted((r.row.page_id, r.text) for r in html_text.extract(pages).collect())
    assert got[:4] == [(1, ""), (2, ""), (3, "a"), (3, "a")] and got[-1][1] == "\n\n".join("w" * 20_000)
    assert html_text.extract(pages.filter("false")).count() == 0


def test_given_pages_give_their_articles(spark, sf_dir):
    import html

    source = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in queries.op3_html_text(spark, sf_dir).collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", source[r.page_id], re.S)[1]
        parts = (html.unescape(re.sub("<[^>]+>", " ", x)) for x in re.split("</?(?:p|h1)>", inner))
        want = "\n\n".join(x for x in (" ".join(p.split()) for p in parts) if x)
        assert r.text == want and r.n_chars == len(want)


SENTENCE = "Rain fell on the harbour all morning and the boats stayed in."


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<html><head><title>t</title><meta a=b><body><nav>x y</nav><article><p>{SENTENCE}</p></article>", SENTENCE),
        (f"<head><script>x</script>{SENTENCE} {SENTENCE}", f"{SENTENCE} {SENTENCE}"),
        (f"<div class='content no-sidebar'><p>{SENTENCE}</p></div>", SENTENCE),
        (f"<main class='with-sidebar'><p>{SENTENCE}</p></main><div class='sidebar'><p>{SENTENCE}</p></div>", SENTENCE),
        (f"<body class='has-footer nav-open menu'><div class=content><p>{SENTENCE}</p></div></body>", SENTENCE),
        (f"<article><div class='post-header'><h1>A day</h1></div><p>{SENTENCE}</p></article>", f"A day\n\n{SENTENCE}"),
        (f"<article><p>{SENTENCE}</p><div class='post-comments'><p>{SENTENCE}</p></div></article>", SENTENCE),
        (f"<div class='content-sidebar'><p>{SENTENCE}</p></div>", ""),
        (f"<article><p>{SENTENCE} <a title=Bob's href=/x>Boats</a> it isn't all.</p></article>", f"{SENTENCE} Boats it isn't all."),
        (f"<article><p title=\"a > b\" alt='c > d'>{SENTENCE}</p></article>", SENTENCE),
        (f"<article><select><option>one</select><p>{SENTENCE}</p><svg><text>drawn</text></svg></article>", SENTENCE),
        (f"<article><svg><p>{SENTENCE}</p></article>", SENTENCE),
    ],
)
def test_articles_behind_odd_markup(page, want):
    assert html_text.main_text(page, TREE) == want


# --- licences ---


def test_license_scan_and_inheritance(spark):
    rows = [
        ("a/LICENSE", "Released under the MIT License."),
        ("a/x.txt", "nothing here"),
        ("a/b/c/y.txt", None),
        ("a/b/z.txt", "some words of prose\nLicensed under the Apache License, Version 2.0.\nmore words"),
        ("q/b.txt", "plain text about a license that we lost"),
        ("q/long.txt", "word of the day " * 20_000 + "\nLicensed under CC BY-NC 4.0."),
        (None, ""),
        ("a/x.txt", "nothing here"),
    ]
    files = clashing(spark.createDataFrame(rows, "path string, text string"))
    got = sorted((r.path, r.license, r.origin, r.from_dir) for r in licenses.scan(files, "path", "text", ("path",)).collect())
    assert got == [
        ("", None, "none", None),
        ("a/LICENSE", "MIT", "own", None),
        ("a/b/c/y.txt", "MIT", "inherited", "a"),
        ("a/b/z.txt", "Apache-2.0", "own", None),
        ("a/x.txt", "MIT", "inherited", "a"),
        ("a/x.txt", "MIT", "inherited", "a"),
        ("q/b.txt", None, "none", None),
        ("q/long.txt", "CC-BY-NC-4.0", "own", None),
    ]
    assert licenses.scan(files.filter("false"), "path", "text").count() == 0


def test_wrapped_licence_files_license_their_directories(spark):
    import textwrap

    wrap = lambda text, mark="", width=72: "\n".join(
        f"{mark}{line}".rstrip() for part in text.split("\n\n") for line in [*textwrap.wrap(part, width), ""]
    )
    named = lambda text: text.replace("\n\n", "\n\nCopyright (c) 2021, The Harbour Post\n\n", 1)
    rows = [(f"{k}/LICENSE", wrap(named(licenses.BODIES[k]))) for k in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Apache-2.0")]
    rows += [(f"{k}/src/x.py", "no licence in here") for k in licenses.BODIES]
    rows += [
        ("c/x.c", "/*\n" + wrap(licenses.BODIES["Apache-2.0"], " * ", 60) + " */\n" + "int main() { return 0; }\n" * 200),
        ("c/y.py", "first line\n" + wrap(licenses.BODIES["GPL-3.0"], "# ") + "import os\n" * 300),
        ("c/z.txt", "nothing of the kind"),
    ]
    # Other texts, so that common words weigh little.
    rows += [(f"other/{k}", f"{FILLER_WORDS[k % 7]} the use of any software is with the author and to copy it is free {k}") for k in range(60)]
    files = spark.createDataFrame(rows, "path string, text string")
    got = {r.path: (r.license, r.origin, r.from_dir) for r in licenses.scan(files, "path", "text").collect()}
    for k in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Apache-2.0"):
        assert got[f"{k}/LICENSE"] == (k, "own", None)
        assert got[f"{k}/src/x.py"] == (k, "inherited", k)
    assert got["GPL-3.0/src/x.py"] == (None, "none", None)
    assert got["c/x.c"][:2] == ("Apache-2.0", "own") and got["c/y.py"][:2] == ("GPL-3.0", "own")
    assert got["c/z.txt"] == (None, "none", None)
    assert {v[0] for k, v in got.items() if k.startswith("other/")} == {None}


FILLER_WORDS = "harbour boats rain kettle nets shed gulls".split()


def test_licenses_match_brute_force_cosine(spark, sf_dir):
    """Every sentence against every template, without anchors."""
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    words = {i: licenses.plain_words(t) for i, t in docs.items()}
    df = Counter(w for row in words.values() for w in set(row))
    known, n = set(licenses.vocabulary()), len(docs)
    idf = lambda w: math.log((n + 1) / ((df[w] if w in known else 0) + 1)) + 1

    def vector(row):
        v = {w: c * idf(w) for w, c in Counter(row).items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {w: x / norm for w, x in v.items()}

    templates = [(k, vector(row)) for k, row in licenses.template_sentences()]
    want = {}
    for i, text in docs.items():
        best = (0.0, "")
        for sentence in re.split(r"\n|(?<=[.!?:;])\s", text) + re.split(r"(?<=[.!?])\s+|\n[^A-Za-z0-9\n]*\n", text):
            v = vector(licenses.plain_words(sentence))
            for name, t in templates:
                cosine = round(sum(x * t.get(w, 0.0) for w, x in v.items()), 6)
                if cosine >= licenses.THRESHOLD and (cosine, [-ord(c) for c in name]) > (best[0], [-ord(c) for c in best[1]]):
                    best = (cosine, name)
        if best[0]:
            want[i] = best[1]
    got = {r.doc_id: r.license for r in queries.op8_licenses(spark, sf_dir).filter("origin = 'own'").collect()}
    assert got == want


def test_only_sentences_near_a_template_are_shuffled(spark, monkeypatch):
    """The bound lets every sentence through that reaches the threshold, and keeps prose with licence words out."""
    rng = random.Random(4)
    idf = {w: 1 + rng.random() * 6 for w in licenses.vocabulary()}
    unseen = 9.0
    vector = lambda words: {w: n * idf.get(w, unseen) for w, n in Counter(words).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    templates = [(name, vector(words)) for name, words in licenses.template_sentences()]
    rows = [(w, name, k, x / norm(t)) for k, (name, t) in enumerate(templates) for w, x in t.items()]
    sentences = []
    for _, words in licenses.template_sentences():
        for _ in range(12):
            kept = [w for w in words if rng.random() < 0.8] or words
            sentences.append(kept + rng.choices([*idf, "harbour", "boats", "x1", "x2"], k=rng.randrange(6)))
    sentences += [rng.choices([*idf], k=8) for _ in range(100)] + [[], ["harbour"] * 5]
    frame = spark.createDataFrame([(k, s) for k, s in enumerate(sentences)], "k int, words array<string>")
    passed = {r.k for r in frame.filter(licenses.possible(F.col("words"), idf, unseen, rows)).collect()}
    for k, s in enumerate(sentences):
        v = vector(s)
        cosines = [sum(x * t.get(w, 0.0) for w, x in v.items()) / norm(v) / norm(t) for _, t in templates] if s else [0.0]
        assert k in passed or round(max(cosines), 6) < licenses.THRESHOLD
    assert len(sentences) - 1 not in passed and len(sentences) - 2 not in passed

    tables = {}
    kept_staged = licenses.staged
    monkeypatch.setattr(licenses, "staged", lambda df, name: tables.setdefault(name, kept_staged(df, name)))
    prose = "the author of this file may use the license free of charge in any copy that rain and boats left"
    rows = [(f"p/{k}", f"{FILLER_WORDS[k % 7]} {prose} {k}") for k in range(50)] + [("q/x", "Released under the MIT License.")]
    got = licenses.scan(spark.createDataFrame(rows, "path string, text string"), "path", "text").filter("license is not null").collect()
    assert [(r.path, r.license) for r in got] == [("q/x", "MIT")]
    assert {r.path for r in tables["licence-words"].select("file.path").collect()} == {"q/x"}
