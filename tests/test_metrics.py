import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import activity, entities, flows, metrics, rankings, spine, totals

TRANSFER = "from_address string, to_address string, token_address string, value decimal(18,2), amount decimal(18,2), date_time timestamp_ntz, transaction_date date"


def d(text):
    return dt.date.fromisoformat(text)


def row(day, sender="a", receiver="b", token="T", value=1, amount=None, hour=0):
    at = dt.datetime.combine(d(day), dt.time(hour, 30))
    return (sender, receiver, token, Decimal(value), None if amount is None else Decimal(amount), at, d(day))


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), TRANSFER)


def listed(spark, first, last, tokens=("T", "U")):
    base = spark.createDataFrame([(t,) for t in tokens], "token_address string")
    return spine.spine_days(base, F.lit(d(first)), F.lit(d(last)))


def table(df, *names):
    return {tuple(str(r[n]) for n in names): r.value_num for r in df.collect()}


@pytest.fixture(scope="module")
def moves(spark):
    # 2019-03-31 is a Sunday and a month end, 2019-04-01 a Monday.
    return frame(
        spark,
        row("2019-03-25", value=1, amount=10),
        row("2019-03-31", value=2),
        row("2019-04-01", value=4, amount=0),
        row("2019-04-03", value=8, amount=5),
        row("2019-04-05", value=16, token="X"),
    )


def test_weeks_and_months_start_where_they_should(spark, moves):
    days = listed(spark, "2019-03-25", "2019-04-07")
    week = table(metrics.rollup_metric(moves, days, "volume", "week"), "token_address", "transaction_date")
    assert week == {("T", "2019-03-25"): 3, ("T", "2019-04-01"): 12, ("U", "2019-03-25"): 0, ("U", "2019-04-01"): 0}
    month = table(metrics.rollup_metric(moves, days, "amount", "month"), "token_address", "transaction_date")
    assert month == {("T", "2019-03-01"): 10, ("T", "2019-04-01"): 5, ("U", "2019-03-01"): 0, ("U", "2019-04-01"): 0}


def test_incremental_week_is_to_date_and_month_is_whole(spark, moves):
    days = listed(spark, "2019-03-25", "2019-04-07")
    week = metrics.rollup_metric(moves, days, "trades", "week", "2019-04-02")
    assert table(week, "token_address", "transaction_date") == {("T", "2019-04-01"): 1, ("U", "2019-04-01"): 0}
    month = metrics.rollup_metric(moves, days, "trades", "month", "2019-04-02")
    assert table(month, "token_address", "transaction_date") == {("T", "2019-04-01"): 2, ("U", "2019-04-01"): 0}


@pytest.mark.parametrize("measure", ["volume", "amount", "trades"])
def test_days_add_up_and_all_grains_agree(spark, moves, measure):
    days = listed(spark, "2019-03-25", "2019-04-07")
    together = metrics.rollup_grains(moves, days, measure)
    for grain in ("day", "week", "month"):
        alone = metrics.rollup_metric(moves, days, measure, grain)
        part = together.where(F.col("grain") == grain).drop("grain")
        assert sorted(part.collect()) == sorted(alone.collect())
    total = lambda g: together.where(F.col("grain") == g).agg(F.sum("value_num")).collect()[0][0]
    assert total("day") == total("week") == total("month")


def test_daily_runs_give_the_backfill(spark, moves):
    days = listed(spark, "2019-03-25", "2019-04-07")
    full = sorted(metrics.rollup_metric(moves, days, "volume").collect())
    runs = [metrics.rollup_metric(moves, days, "volume", day=d("2019-03-25") + dt.timedelta(days=n)).collect() for n in range(14)]
    assert sorted(r for run in runs for r in run) == full


def test_average_counts_priced_rows_only_when_asked(spark, moves):
    days = listed(spark, "2019-03-25", "2019-04-03", ("T",))
    both = frame(spark, row("2019-03-25", value=1, amount=10), row("2019-03-25", value=3, amount=0))
    assert table(metrics.avg_metric(both, days, "value", "2019-03-25"), "token_address") == {("T",): 2.0}
    assert table(metrics.avg_metric(both, days, "amount", "2019-03-25", positive=True), "token_address") == {("T",): 10.0}


def test_hours_stop_at_the_latest_with_data(spark):
    moves = frame(spark, row("2019-01-01", hour=2), row("2019-01-01", hour=18, token="U", value=5), row("2019-01-02", hour=23))
    days = listed(spark, "2019-01-01", "2019-01-01")
    got = table(metrics.hourly_metric(moves, days, "volume", "2019-01-01"), "token_address", "transaction_date")
    assert len(got) == 2 * 19
    assert got[("T", "2019-01-01 02:00:00")] == 1 and got[("U", "2019-01-01 18:00:00")] == 5
    assert metrics.hourly_metric(moves, days, "trades").count() == 48
    assert metrics.hourly_metric(moves, days, "trades", "2018-12-31").count() == 0


def test_first_seen_and_repeated_day(spark):
    moves = frame(spark, row("2019-01-01", "a", "b", hour=5), row("2019-01-01", "b", "a", hour=3), row("2019-01-02", "c", "a"), row("2019-01-02", "c", "c", "U"))
    full = entities.first_seen(moves)
    got = {(r.customer_address, r.token_address): (r.dh, str(r.transaction_date)) for r in full.collect()}
    assert got == {("a", "T"): ("03", "2019-01-01"), ("b", "T"): ("03", "2019-01-01"), ("c", "T"): ("00", "2019-01-02"), ("c", "U"): ("00", "2019-01-02")}
    again = entities.first_seen(moves, day="2019-01-02", known=full)
    assert sorted(r.customer_address for r in again.collect()) == ["c", "c"]
    senders = entities.first_seen(moves, sides=("from_address",))
    assert {r.customer_address for r in senders.collect()} == {"a", "b", "c"}
    with pytest.raises(ValueError):
        entities.first_seen(moves, day="2019-01-02")


@pytest.mark.parametrize("gap, dormant_before, wakes", [(60, 0, 0), (61, 0, 0), (62, 1, 1), (63, 1, 1)])
def test_idle_windows(spark, gap, dormant_before, wakes):
    start = d("2019-01-01")
    back = start + dt.timedelta(days=gap)
    moves = frame(spark, row("2019-01-01"), row(back.isoformat()))
    first_sent = entities.first_seen(moves, sides=("from_address",))
    days = listed(spark, "2019-01-01", "2019-06-30", ("T",))
    value = lambda df: df.collect()[0].value_num
    yesterday = back - dt.timedelta(days=1)
    assert value(activity.dormant(first_sent, moves, days, yesterday)) == dormant_before
    assert value(activity.dormant(first_sent, moves, days, back)) == 0
    assert value(activity.awakened(first_sent, moves, days, back)) == wakes
    history = table(activity.awakened_history(moves, days), "transaction_date")
    assert history[(back.isoformat(),)] == wakes and sum(history.values()) == wakes


def test_dormant_equals_last_send(spark, sf_dir):
    from ledgerlake.plans import views as V

    moves = V.transfers(spark, sf_dir)
    first_sent = entities.first_seen(moves, sides=("from_address",))
    days = V.transfer_spine(spark, sf_dir)
    got = activity.dormant(first_sent, moves, days, V.DAY).where("value_num > 0")
    last = moves.where(F.col("transaction_date") <= V.DAY).groupBy("from_address", "token_address").agg(F.max("transaction_date").alias("last"))
    want = last.where(F.date_diff(F.lit(V.DAY).cast("date"), "last") >= 61).groupBy("token_address").count()
    assert {r.token_address: r.value_num for r in got.collect()} == {r.token_address: r["count"] for r in want.collect()}


def test_totals_daily_and_full(spark):
    moves = frame(spark, row("2019-01-01", "a", "b"), row("2019-01-03", "c", "d", "U"), row("2019-01-03", "a", "c"), row("2019-01-04", "e", "a"))
    days = listed(spark, "2019-01-01", "2019-01-05")
    seen = entities.first_seen(moves)
    full = totals.running_total_by_token(seen, days)
    assert table(full, "token_address", "transaction_date")[("T", "2019-01-05")] == 4
    by_token = {t: [r.value_num for r in full.where(F.col("token_address") == t).orderBy("transaction_date").collect()] for t in "TU"}
    assert by_token == {"T": [2, 2, 3, 4, 4], "U": [0, 0, 2, 2, 2]}
    prior = totals.running_total_by_token(seen, days.where("transaction_date <= date'2019-01-01'"))
    for n in (2, 3, 4, 5):
        day = f"2019-01-0{n}"
        prior = totals.running_total_by_token_day(seen, days, prior, day)
        assert sorted(prior.collect()) == sorted(full.where(F.col("transaction_date") == day).collect())
    native = entities.first_seen(moves, [])
    assert [r.value_num for r in totals.running_total(native).orderBy("transaction_date").collect()] == [2, 4, 5]
    step = totals.running_total_day(native, totals.running_total(native), "2019-01-04").collect()
    assert [tuple(r) for r in step] == [(5, d("2019-01-04"))]


def test_totals_after_quiet_days_and_on_a_list_with_gaps(spark):
    moves = frame(spark, row("2019-01-01", "a", "b"), row("2019-01-02", "c", "a"), row("2019-01-03", "d", "a"))
    native = entities.first_seen(moves.where("transaction_date != date'2019-01-02'"), [])
    prior = totals.running_total(native.where("transaction_date < date'2019-01-03'"))
    assert [r.value_num for r in totals.running_total_day(native, prior, "2019-01-03").collect()] == [3]
    assert [r.value_num for r in totals.running_total_day(native, prior.where("false"), "2019-01-03").collect()] == [3]
    seen = entities.first_seen(moves)
    days = listed(spark, "2019-01-01", "2019-01-03").where("transaction_date != date'2019-01-02' and token_address = 'T'")
    full = totals.running_total_by_token(seen, days)
    assert sorted((str(r.transaction_date), r.value_num) for r in full.collect()) == [("2019-01-01", 2), ("2019-01-03", 4)]
    prior = full.where("transaction_date < date'2019-01-03'")
    step = totals.running_total_by_token_day(seen, days, prior, "2019-01-03").collect()
    assert [(r.token_address, r.value_num) for r in step] == [("T", 4)]


def test_flows_ignore_duplicate_listings(spark):
    moves = frame(spark, row("2019-01-01", "a", "x", value=3), row("2019-01-01", "x", "a", value=5), row("2019-01-02", "a", "x", value=7))
    exchanges = spark.createDataFrame([("x",), ("x",)], "address string")
    assert table(flows.party_flow(moves, exchanges), "address", "transaction_date") == {("x", "2019-01-01"): 3, ("x", "2019-01-02"): 7}
    assert table(flows.party_flow(moves, exchanges, "from_address", "2019-01-01"), "address") == {("x",): 5}


def test_ranking_ties_windows_and_self_transfers(spark):
    moves = frame(spark, row("2019-01-31", "s", "s"), row("2019-01-31", "b", "c"), row("2019-01-31", "a", "d"), row("2019-01-24", "a", "q"), row("2019-01-23", "z", "z"), row("2019-01-01", "m", "m"), row("2018-12-31", "n", "n"))
    order = lambda back, k: [(r.customer_address, r.value_num) for r in rankings.top_participants(moves, "2019-01-31", back, k).orderBy(F.desc("value_num"), "customer_address").collect()]
    assert order(0, 3) == [("s", 2), ("a", 1), ("b", 1)]
    assert order(7, 2) == [("a", 2), ("s", 2)]
    assert [a for a, _ in order(30, 100)] == ["a", "m", "s", "z", "b", "c", "d", "q"]


def test_long_rankings_go_through_slices(spark):
    rows = spark.range(5000).selectExpr("'T' as token", "cast(id as string) as who", "id % 97 as n")
    args = ([F.desc("n"), F.asc("who")], 1500)
    sliced = rankings.top_k(rows, ["token"], *args, spread=["who"])
    assert "_slice" in sliced._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(sliced.collect()) == sorted(rankings.top_k(rows, ["token"], *args).collect())


def _made_moves(spark, n=400, seed=4):
    import random

    rng = random.Random(seed)
    day = lambda: str(d("2019-01-01") + dt.timedelta(days=rng.choice((rng.randrange(200), rng.randrange(30)))))
    return frame(spark, *[row(day(), f"s{rng.randrange(9)}", f"s{rng.randrange(12)}", rng.choice("TU")) for _ in range(n)])


def test_dormant_history_equals_daily_runs(spark):
    made = _made_moves(spark, 60).cache()
    days = listed(spark, "2019-01-01", "2019-09-30")
    first_sent = entities.first_seen(made, ["token_address"], ("from_address",)).cache()
    full = table(activity.dormant_history(made, days), "token_address", "transaction_date")
    assert len(full) == 2 * 273 and max(full.values()) > 2
    for day in ("2019-01-01", "2019-03-10", "2019-04-02", "2019-06-30", "2019-09-30"):
        daily = table(activity.dormant(first_sent, made, days, day), "token_address", "transaction_date")
        assert {key: full[key] for key in daily} == daily
    assert set(table(activity.dormant_history(made.where("false"), days), "token_address", "transaction_date").values()) == {0}


@pytest.mark.parametrize("back", [0, 7, 30, 70])
def test_ranking_history_equals_daily_runs(spark, back):
    made = _made_moves(spark).cache()
    names = ("customer_address", "token_address", "transaction_date")
    full = table(rankings.top_participants_history(made, back, 3), *names)
    some = table(rankings.top_participants_history(made, back, 3, first="2019-02-01", last="2019-03-15"), *names)
    for k in range(0, 190, 9):
        day = str(d("2019-01-03") + dt.timedelta(days=k))
        daily = table(rankings.top_participants(made, day, back, 3), *names)
        if day <= max(key[2] for key in full):
            assert {key: v for key, v in full.items() if key[2] == day} == daily
        if "2019-02-01" <= day <= "2019-03-15":
            assert {key: v for key, v in some.items() if key[2] == day} == daily
    assert rankings.top_participants_history(made.where("false"), back, 3).collect() == []


def test_long_stretches_are_few_spans(spark):
    """A constant count over n days becomes at most two spans of each length but the longest."""
    cases = [(s, s + n) for s in (-70, 0, 13, 18_000) for n in (1, 2, 31, 32, 63, 64, 200, 1000)]
    df = spark.createDataFrame(cases, "a int, b int").select("a", "b", rankings._pieces(F.col("a"), F.col("b")).alias("p"))
    for r in df.collect():
        covered = [x for level, number in r.p for x in range(number << level, (number + 1) << level)]
        assert sorted(covered) == list(range(r.a, r.b))
        assert len(r.p) <= 10 + (r.b - r.a) // 32


def test_running_total_needs_no_single_task(spark):
    """Over gaps of years, and without a shuffle to one partition."""
    days = ["2015-12-31", "2016-01-01", "2016-01-01", "2016-05-05", "2019-02-02", "2019-02-03", "2023-01-01"]
    seen = spark.createDataFrame([(f"a{k}", d(x)) for k, x in enumerate(days)], "customer_address string, transaction_date date")
    got = {str(r.transaction_date): r.value_num for r in totals.running_total(seen).collect()}
    assert got == {x: sum(y <= x for y in days) for x in days}
    assert totals.running_total(seen.where("false")).collect() == []
    plan = totals.running_total(seen)._jdf.queryExecution().toString()
    main = plan[plan.index("== Physical Plan =="):].split("Subquery")[0]
    assert "SinglePartition" not in main


@pytest.mark.parametrize("grain", ["day", "week", "month"])
@pytest.mark.parametrize("measure", ["volume", "trades"])
def test_a_range_equals_its_daily_runs(spark, grain, measure):
    made = _made_moves(spark, 150).withColumn("value", F.concat(F.col("value").cast("int"), F.lit("." + "0" * 30 + "1"))).cache()  # text of any width
    days = listed(spark, "2019-01-01", "2019-06-30").where("not (token_address = 'U' and transaction_date = '2019-02-03')")
    got = metrics.rollup_range(made, days, measure, grain, "2019-01-25", "2019-02-12")
    full = {(str(r.run_date), r.token_address, str(r.transaction_date)): r.value_num for r in got.collect()}
    want = {}
    for k in range(19):
        day = str(d("2019-01-25") + dt.timedelta(days=k))
        for r in metrics.rollup_metric(made, days, measure, grain, day).collect():
            want[day, r.token_address, str(r.transaction_date)] = r.value_num
    assert full == want
