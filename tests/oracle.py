"""Run a query and its SQL twin side by side and compare the rows."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows(columns: list[str], data: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    shown = [tuple(repr(row[i]) for i in order) for row in data]
    return sorted(columns), sorted(shown)


def compare(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want = rows([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows, expected {len(want[1])}"
    for left, right in zip(got[1], want[1]):
        if left != right:
            return f"row {left} != {right}"
    return None if got[1] else "empty"
