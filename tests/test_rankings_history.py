"""Rankings of all days: only what can be among the best is sorted and shuffled by day."""

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from ledgerlake.operators import rankings

SCHEMA = "from_address string, to_address string, token_address string, transaction_date date"
FIRST = dt.date(2020, 1, 1)


def brute(rows, back, k):
    days = [FIRST + dt.timedelta(days=n) for n in range((max(r[3] for r in rows) - FIRST).days + 1)]
    out = set()
    for day in days:
        seen = {}
        for a, b, token, d in rows:
            if day - dt.timedelta(days=back) <= d <= day:
                seen.setdefault(token, Counter()).update([a, b])
        for token, counts in seen.items():
            best = sorted(counts.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[:k]
            out |= {(n, address, token, day) for address, n in best}
    return out


def test_rare_addresses_stay_out_of_the_sort(spark, monkeypatch):
    """Each day 40 new addresses move once, and twelve move again and again; a token with few addresses keeps all."""
    rows = []
    for day in range(30):
        date = FIRST + dt.timedelta(days=day)
        rows += [(f"once{day}-{n}", "hub0", "a", date) for n in range(40)]
        rows += [(f"hub{n % 12}", f"hub{(n * 5 + day) % 12}", "a", date) for n in range(36)]
        rows += [(f"few{n}", None, "b", date) for n in range(day % 4)]
        rows += [("x", "y", None, date)] * (day % 3)
    seen = []
    kept = rankings.top_k

    def counted(df, by, order, k, spread=()):
        seen.append(df.count())
        return kept(df, by, order, k, spread)

    monkeypatch.setattr(rankings, "top_k", counted)
    for back, k in ((6, 5), (0, 3), (40, 11)):
        seen.clear()
        got = rankings.top_participants_history(spark.createDataFrame(rows, SCHEMA), back, k)
        assert {tuple(r) for r in got.collect()} == brute(rows, back, k)
        if back == 6:
            assert seen[0] < 1200  # one row at least for each of the 1200 addresses before


def test_counts_of_any_width_keep_their_order(spark):
    rows = [(f"a{n:02}", f"b{n:02}", "t", FIRST + dt.timedelta(days=n % 2)) for n in range(40) for _ in range(60 + 9 * n)]
    got = rankings.top_participants_history(spark.createDataFrame(rows, SCHEMA), 1, 7)
    assert {tuple(r) for r in got.collect()} == brute(rows, 1, 7)


def test_rounded_is_never_more(spark):
    rows = spark.range(1, 5000).select("id", rankings._rounded(F.col("id")).alias("r"))
    wide = spark.createDataFrame([((1 << n) - 1 + m,) for n in range(1, 62) for m in (0, 1)], "id bigint")
    rows = rows.unionByName(wide.select("id", rankings._rounded(F.col("id")).alias("r")))
    assert rows.where("r > id OR r < id * 0.96 OR (id < 32 AND r <> id)").count() == 0
