"""One key holding a third of all rows: same results, and no task that gets them all."""

import datetime as dt
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import activity, entities, metrics, rankings, spine, transfers

ROWS = 300_000
HOT = "id % 3 = 0"


@contextmanager
def settings(spark, **conf):
    keys = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


SMALL_LIMITS = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "200KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "200KB",
}


def final_plan(df):
    """The adapted plan after the frame was counted row by row."""
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def moves(spark):
    day = "date_add(date'2019-01-01', cast(id % 90 as int))"
    return spark.range(0, ROWS, 1, 8).selectExpr(
        f"case when {HOT} then 'hot' else concat('a', id % 1000) end as from_address",
        f"case when {HOT} then 'hot' else concat('b', id % 500) end as to_address",
        f"case when {HOT} then 'T' else concat('t', id % 50) end as token_address",
        "cast(1 as decimal(38,18)) as value",
        "cast(null as decimal(38,18)) as amount",
        f"cast({day} as timestamp_ntz) as date_time",
        f"{day} as transaction_date",
    )


def test_aggregates_shrink_the_hot_key_before_the_shuffle(spark, moves):
    tokens = moves.select("token_address").distinct()
    days = spine.spine_days(tokens, F.lit(dt.date(2019, 1, 1)), F.lit(dt.date(2019, 3, 31)))
    for df in (
        metrics.rollup_metric(moves, days, "volume"),
        entities.first_seen(moves),
        rankings.top_participants(moves, "2019-03-31", 30),
        activity.awakened_history(moves, days),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    volume = metrics.rollup_metric(moves, days, "volume", "month").groupBy("token_address").agg(F.sum("value_num").alias("v"))
    assert {r.token_address: r.v for r in volume.collect()}["T"] == ROWS / 3
    top = rankings.top_participants(moves, "2019-03-31", 89, 1).where("token_address = 'T'").collect()[0]
    assert (top.customer_address, top.value_num) == ("hot", 2 * ROWS // 3)


def test_hot_transaction_is_split_in_the_semi_joins(spark, tmp_path):
    tx = f"case when {HOT} then 'hot' else concat('x', id % 5000) end"
    logs = spark.range(0, ROWS, 1, 8).selectExpr(
        "cast(1 as bigint) as block_number", "date'2019-01-01' as transaction_date", "'0' as logs_transaction_index",
        f"{tx} as logs_transaction_hash", "uuid() as filler")
    logs.select("block_number", "transaction_date", "logs_transaction_hash").distinct().write.parquet(f"{tmp_path}/keys")
    keys = spark.read.parquet(f"{tmp_path}/keys")
    receipts = keys.selectExpr("block_number", "transaction_date", "'0' as receipt_transaction_index",
                               "logs_transaction_hash as receipt_transaction_hash", "'true' as receipt_status")
    traces = keys.selectExpr("block_number", "transaction_date", "'0x0' as trace_transaction_index",
                             "logs_transaction_hash as trace_transaction_hash", "'' as trace_error")
    with settings(spark, **SMALL_LIMITS):
        rows, plan = final_plan(transfers.valid_transfers(logs, receipts, traces).groupBy().count())
    assert rows[0][0] == ROWS
    assert "skew=true" in plan.split("Initial Plan")[0]


def test_hot_token_is_split_in_the_lookups(spark, tmp_path):
    token = f"case when {HOT} then '0xhot' else concat('0x', id % 5000) end"
    moves = spark.range(0, ROWS, 1, 8).selectExpr(
        "id as block_number", f"{token} as logs_address", "uuid() as from_address", "'0xb' as to_address", "'5' as value",
        "'0' as logs_transaction_index", "'0xt' as logs_transaction_hash",
        "timestamp_ntz'2019-01-01 00:00:00' as date_time", "date'2019-01-01' as transaction_date")
    tokens = moves.select("logs_address").distinct().selectExpr(
        "logs_address as id", "logs_address as address", "0 as decimals", "'S' as token_symbol")
    tokens.write.parquet(f"{tmp_path}/token")
    tokens = spark.read.parquet(f"{tmp_path}/token")
    prices = tokens.selectExpr("id", "cast(2 as decimal(20,8)) as price_us", "date'2019-01-01' as transaction_date")
    with settings(spark, **SMALL_LIMITS):
        priced = transfers.enrich_transfers(moves, tokens, prices).groupBy("amount").agg(
            F.count("*").alias("n"), F.max("from_address")
        )
        rows, plan = final_plan(priced)
    assert [(int(r.amount), r.n) for r in rows] == [(10, ROWS)]
    assert "skew=true" in plan.split("Initial Plan")[0]


def test_no_query_multiplies_rows_pairwise(spark, sf_dir):
    import __spark_entry__ as entry

    for name in ("dormant_day", "awakened_day", "volume_hour", "spine_hours", "block_rewards", "transfer_enrich", "exchange_out_full"):
        plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
