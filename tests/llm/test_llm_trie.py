"""The conversation trie against a plain Python version."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import turn_trie

TURNS = "conv_id long, turn long, role string, text string"


def turn_id(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def plain(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, turn_id(role or "", text or ""), role or "", text or ""))
    turns = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        seqs[c] = tuple(turns.get(base, [])[:h] + mine[h:])
    nodes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        leaves = [q for q in below if not any(r[:-1] == q for r in nodes if len(r) == len(q) + 1)]
        ends = ",".join(map(str, sorted(c for c in members if seqs[c] == p)))
        out.append(
            (
                min(members),
                len(p),
                min(nodes[p[:-1]]) if p else None,
                len(members),
                sum(1 for q in nodes if len(q) == len(p) + 1 and q[:-1] == p),
                len(leaves),
                saved,
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def clashing(df):
    for name in ("base", "own", "head", "ids", "sizes", "kind", "unit", "key", "depth"):
        df = df.withColumn(name, F.lit("x"))
    return df


def made(n, seed, words=3, longest=12):
    rng = random.Random(seed)
    return [
        (c, t, rng.choice(("user", "bot")), rng.choice(("a", "é b", "漢", None)[:words]))
        for c in range(n)
        for t in range(rng.randrange(1, longest))
    ]


EDGES = [
    (None, 1, "user", "no conversation"),
    (-7, 1, "user", "below zero"),
    (-5, 1, "user", "its base"),
    (-(2**63), 0, "user", "least"),
    (2**63 - 1, 0, "user", "most"),
    (100, None, None, None),
    (100, None, "user", ""),
    (100, 3, "user", "tie b"),
    (100, 3, "user", "tie a"),
    (100, 3, "user", "tie a"),
    (101, 1, "us", "erx"),
    (102, 1, "user", "x"),
    *[(205, t, "user", f"t{t % 7}") for t in range(75)],
    *[(206, t, "user", f"t{t % 7}") for t in range(70)],
    *[(210, t, "user", f"t{t % 7}") for t in range(75)],
]


@pytest.mark.parametrize("partitions", ["1", "5", "40"])
def test_trie_matches_brute_force(spark, monkeypatch, partitions):
    monkeypatch.setattr(turn_trie, "FAN_IN", 3)  # several rounds of merging
    monkeypatch.setattr(turn_trie, "CHUNK", 4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = EDGES + [(c + 1000, *rest) for c, *rest in made(40, 1, words=1, longest=4)] + made(30, 2)
        assert got(turn_trie.trie(clashing(spark.createDataFrame(rows, TURNS).repartition(3)))) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_many_copies_spread(spark):
    """One conversation that most rows repeat is a path with all of them."""
    rows = [(5 * c, t, "user", f"same {t}") for c in range(300) for t in range(3)] + [(1, 0, "user", "other")]
    assert got(turn_trie.trie(spark.createDataFrame(rows, TURNS))) == plain(rows)


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, 1, "user", "x")], TURNS)
    assert turn_trie.trie(df.filter("false")).collect() == []
    assert turn_trie.trie(df.withColumn("conv_id", F.lit(None).cast("long"))).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_shards_and_merges_in_plain_calls(seed, monkeypatch):
    """Any cut of the sorted conversations into shards gives the same trie."""
    monkeypatch.setattr(turn_trie, "WIDTH", 4)
    rng = random.Random(seed)
    seqs = sorted(
        (tuple(turn_id("u", rng.choice("ab")) for _ in range(rng.randrange(0, 11))), c) for c in range(60)
    )
    cuts = sorted(rng.sample(range(1, 60), 7))
    closed, opens, ends = [], [], {}
    for unit, (a, b) in enumerate(zip([0, *cuts], [*cuts, 60])):
        some = seqs[a:b]
        rng.shuffle(some)
        ids = np.frombuffer(b"".join(t for s, _ in some for t in s), dtype=">u8")
        length = np.array([len(s) for s, _ in some])
        for part in turn_trie.shard(unit, np.array([c for _, c in some]), length, ids, np.ones(len(ids) // 2, dtype=np.int64)):
            for k, kind in enumerate(part["kind"]):
                row = {name: (v.to_pylist() if hasattr(v, "to_pylist") else list(v))[k] for name, v in part.items()}
                if kind == "open":
                    opens.append(row)
                elif kind == "ends":
                    ends.setdefault(row["key"], []).append(row["payload"])
                else:
                    closed.append(row)
    closed += [{name: v[0] for name, v in row.items()} for row in turn_trie.merge(0, opens, True)]
    nodes = {}
    for s, c in seqs:
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    want = sorted(
        (min(m), len(p), len(m), sum(len(nodes[q]) - 1 for q in nodes if q and q[: len(p)] == p)) for p, m in nodes.items()
    )
    assert sorted((r["conv_id"], r["depth"], r["n_convs"], r["saved"]) for r in closed) == want
    assert sum(len(b",".join(v).split(b",")) for v in ends.values()) <= 60
