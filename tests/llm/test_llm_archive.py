"""Packing and packed archives by exact round trips, and the pipeline."""

import io
import random
import struct
import zipfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerlake.llm import packing, queries, warc_zip

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


TOKENIZER = Tokenizer.from_file(VOCABULARY)


def tokens(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]


# --- packing ---


def test_word_cache_gives_the_tokenizers_ids():
    rng = random.Random(4)
    alphabet = "abcAB 0123 \n\t.,!'_-éüñß²½   ªº\x1c\x85漢字🙂́"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(800)]
    texts += ["it's we'll  I'D <|endoftext|> x", "", "a" * 5000, "  \n\n  ", "don't_do  that\n"]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", "<|endoftext| > <endoftext>"]
    assert tokens("a <|endoftext|> b") == [64, 220, 50256, 275, 0]
    encoder = packing.Encoder(VOCABULARY)
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == tokens(text)[:-1]


def check_packed(rows, texts):
    """Every id in one piece, no gap or overlap in a sequence."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for i, own in by_doc.items():
        ids, at = tokens(texts[i]), 0
        for r in sorted(own, key=lambda r: r.start):
            piece = np.array(ids[at : at + r.length], dtype="<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(piece.tobytes()))
            at += r.length
        assert at == len(ids)
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    return sum(r.length for r in rows) / (1024 * len(by_seq))


def test_packing_round_trip(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert check_packed(queries.op4_packing(spark, sf_dir).collect(), texts) > 0.97


def test_packing_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET", 3)  # many buckets for one length
    texts = {1: None, 2: "", 3: "word " * 30_000, 4: "short"} | {k: "same length" for k in range(10, 60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("length", F.lit("x"))
    check_packed(packing.pack(docs, VOCABULARY).collect(), texts)
    twice = packing.pack(docs.filter("doc_id = 4").union(docs.filter("doc_id = 4")), VOCABULARY).collect()
    assert sorted(r.offset for r in twice) == [0, twice[0].length]
    assert packing.pack(docs.filter("false"), VOCABULARY).count() == 0


def test_plan_uses_up_the_histogram():
    rng = np.random.default_rng(5)
    for scale in (1, 50):
        histogram = np.bincount(np.minimum(1024, rng.lognormal(5.5, 1.2, 400 * scale).astype(int) + 1), minlength=1025)
        used = np.zeros(1025, dtype=int)
        for lengths, repeats in packing.plan(histogram):
            assert sum(lengths) <= 1024 and repeats > 0
            for n in lengths:
                used[n] += repeats
        assert (used == histogram).all()


# --- archives ---


def test_package_is_a_zip_and_is_read_by_range():
    sink = io.BytesIO()
    sink_close, sink.close = sink.close, lambda: None
    package = warc_zip.PackageWriter(sink)
    for name, data in (("a/ä.bin", b"x" * 1000), ("b", b"")):
        package.begin(name)
        package.write(data)
        package.end()
    package.close()
    raw = sink.getvalue()
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        assert z.testzip() is None and z.read("a/ä.bin") == b"x" * 1000
    found = warc_zip.stored_members(io.BytesIO(raw), len(raw))
    start, length = found["a/ä.bin"]
    assert raw[start : start + length] == b"x" * 1000 and found["b"][1] == 0
    sink_close()


def test_reader_takes_plain_zip_files_and_names_broken_ones():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("one", b"stored")
        z.writestr("two", b"packed" * 100, zipfile.ZIP_DEFLATED)
        z.comment = b"PK comment"
    data = raw.getvalue()
    found = warc_zip.stored_members(io.BytesIO(data), len(data))
    assert list(found) == ["one"] and data[found["one"][0] :][:6] == b"stored"
    for broken in (b"", b"no zip", data.replace(b"PK\1\2", b"PK\0\0")):
        with pytest.raises((ValueError, struct.error)):
            warc_zip.stored_members(io.BytesIO(broken), len(broken))


PAGES = [
    (3, "http://a/ b\r\nX: y", "<p>same</p>"),
    (1, None, "<p>same</p>"),
    (2, "http://c", None),
    (5, "http://d", ""),
    (7, "http://e", "\r\n\r\nä" * 50_000),
    (8, "http://f", "once"),
    (8, "http://f", "once"),
    (None, "http://g", "once"),
    (None, "http://h", "alone"),
]


@pytest.mark.parametrize("package_bytes", [1, 256 << 20])
def test_archives_round_trip(spark, monkeypatch, package_bytes):
    monkeypatch.setattr(warc_zip, "PACKAGE_BYTES", package_bytes)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("x")).repartition(2)
    rows = warc_zip.round_trip(pages).collect()
    got = sorted((str(r.page_id), r.record_type, str(r.refers_to), r.payload_bytes) for r in rows)
    size = len(("\r\n\r\nä" * 50_000).encode())
    assert got == [
        ("1", "response", "None", 11),
        ("2", "response", "None", 0),
        ("3", "revisit", "1", 11),
        ("5", "revisit", "2", 0),
        ("7", "response", "None", size),
        ("8", "response", "None", 4),
        ("8", "response", "None", 4),
        ("None", "response", "None", 5),
        ("None", "revisit", "8", 4),
    ]
    payloads = {r.page_id: r.payload for r in rows if r.record_type == "response"}
    assert bytes(payloads[7]).decode() == "\r\n\r\nä" * 50_000
    assert [r.url for r in rows if r.page_id == 3] == ["http://a/%20b%0D%0AX:%20y"]
    assert warc_zip.round_trip(pages.filter("false")).count() == 0


def test_small_payloads_stay_responses(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    kinds = {r.page_id: r.record_type for r in warc_zip.round_trip(pages, min_bytes=11, payload=False).collect()}
    assert kinds[3] == "revisit" and kinds[5] == "response"


# --- pipeline ---


def test_pipeline_stages_on_planted_rows(spark, sf_dir, tmp_path):
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    leak = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first().text
    clean = " ".join(f"planted{k} word" for k in range(60))
    planted = [
        (900_001, None, "en", "s", 0),
        (900_002, "12 34 !", "en", "s", 0),
        (900_003, clean, "en", "s", 0),
        (900_004, clean.upper(), "en", "s", 0),
        (900_005, clean + " tail", "en", "s", 0),
        (900_006, f"some words before it {leak} and some after", "en", "s", 0),
    ]
    docs = source.unionByName(spark.createDataFrame(planted, source.schema))
    left = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == source.columns
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        left.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert not {900_001, 900_002} & left[0] and {900_003, 900_004, 900_005, 900_006} <= left[0]
    assert 900_003 not in left[1] and {900_004, 900_005, 900_006} <= left[1]
    assert 900_005 not in left[2] and {900_004, 900_006} <= left[2]
    assert 900_006 not in left[3] and 900_004 in left[3]
    texts = {r.doc_id: r.text for r in docs.collect()}
    check_packed(corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect(), texts)


def test_pipeline_of_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
