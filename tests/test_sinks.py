import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from ledgerlake.sources import readers, sinks, windows
from ledgerlake.sources.dims import load_price_dim, normalise_token_dim


def days(spark, *pairs):
    return spark.createDataFrame([(v, dt.date.fromisoformat(t)) for t, v in pairs], "v string, transaction_date date")


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.write_partitions(days(spark, ("2019-01-01", "old"), ("2019-01-02", "old"), ("2019-01-02", "old")), path)
    fresh = days(spark, ("2019-01-02", "new"), ("2019-01-03", "new"))
    for _ in range(2):
        sinks.write_partitions(fresh, path)
        got = sorted((str(r.transaction_date), r.v) for r in spark.read.parquet(path).collect())
        assert got == [("2019-01-01", "old"), ("2019-01-02", "new"), ("2019-01-03", "new")]


def test_a_small_partition_is_one_file(spark, tmp_path):
    df = spark.range(0, 4000, 1, 8).selectExpr("id", "cast(id % 4 as int) as p")
    sinks.write_partitions(df, f"{tmp_path}/t", ["p"])
    assert [len(glob.glob(f"{tmp_path}/t/p={p}/*.parquet")) for p in range(4)] == [1] * 4


def test_a_hot_partition_is_written_by_many_tasks(spark, tmp_path):
    df = spark.range(0, 400_000, 1, 8).selectExpr("id", "repeat(uuid(), 2) as filler", "cast(id % 100 = 0 as int) as p")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "2MB")
    try:
        sinks.write_partitions(df, f"{tmp_path}/t", ["p"])
    finally:
        spark.conf.unset(key)
    assert len(glob.glob(f"{tmp_path}/t/p=0/*.parquet")) > 4
    assert spark.read.parquet(f"{tmp_path}/t").count() == 400_000


def test_catalog_tables_go_by_name(spark):
    spark.sql("drop table if exists by_name")
    sinks.write_table(spark.sql("select 1 as a, 'x' as b"), "by_name")
    sinks.write_table(spark.sql("select 'y' as b, 2 as a"), "by_name", "append")
    assert sorted(map(tuple, readers.table(spark, "by_name").collect())) == [(1, "x"), (2, "y")]
    sinks.write_table(spark.sql("select 'z' as b, 3 as a"), "by_name", "overwrite")
    assert list(map(tuple, readers.table(spark, "by_name").collect())) == [(3, "z")]
    with pytest.raises(ValueError):
        sinks.write_table(spark.range(1), "by_name", "merge")
    spark.sql("drop table by_name")


def test_partitions_become_visible_once(spark, tmp_path):
    path = f"{tmp_path}/ext"
    df = days(spark, ("2019-01-01", "a"), ("2019-01-02", "b"))
    spark.sql("drop table if exists ext")
    sinks.write_partitions(df, path)
    spark.sql(f"create table ext (v string, transaction_date date) using parquet partitioned by (transaction_date) location '{path}'")
    for _ in range(2):
        sinks.register_partitions(spark, "ext")
        assert spark.sql("show partitions ext").count() == 2
    assert sinks.partition_listing(spark.table("ext"), ["transaction_date"]).count() == 2
    spark.sql("drop table ext")


def test_scan_reads_only_the_partitions_asked_for(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.write_partitions(days(spark, ("2019-01-31", "a"), ("2019-02-01", "b"), ("2019-02-28", "c"), ("2019-03-01", "d")), path)
    df = spark.read.parquet(path)
    read = lambda **k: sorted(r.v for r in readers.scan(df, **k).collect())
    assert read(on="2019-02-01") == ["b"] and read(month="2019-02") == ["b", "c"]
    assert read(since="2019-02-28") == ["c", "d"] and read() == ["a", "b", "c", "d"]
    plan = readers.scan(df, month="2019-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_date" in plan and "DataFilters: []" in plan
    assert sorted(r.v for r in windows.backfill(df, month="2019-02").collect()) == ["b", "c"]
    assert [r.v for r in windows.backfill(df, day="2019-03-01").collect()] == ["d"]
    with pytest.raises(ValueError):
        windows.backfill(df)


def test_a_day_without_rows_keeps_its_partition(spark):
    old = days(spark, ("2019-01-01", "old"), ("2019-01-02", "old"), ("2019-01-03", "old"))
    fresh = days(spark, ("2019-01-01", "new"), ("2019-01-03", "new"))
    got = windows.replace_window(old, fresh, "2019-01-02")
    assert sorted((str(r.transaction_date), r.v) for r in got.collect()) == [
        ("2019-01-01", "old"), ("2019-01-02", "old"), ("2019-01-03", "new")]


def test_windows():
    w = windows.Windows()
    assert [w.since(layer, "2019-03-01").isoformat() for layer in ("raw", "parse", "ods", "ledger")] == [
        "2019-02-27", "2019-02-28", "2019-02-27", "2019-02-26"]


def test_raw_folders(spark, tmp_path):
    for day in ("2019-01-01", "2019-01-02", "2019-01-03", "2019-01-04"):
        folder = tmp_path / f"local_date={day}" / "n1" / "p1"
        os.makedirs(folder)
        (folder / "x.log").write_text(f'{{"number":"{day[-1]}"}}\n')
        (folder / "x.tmp").write_text("half a line")
    got = readers.read_raw(spark, str(tmp_path), "2019-01-04", 2)
    assert sorted(r.info for r in got.collect()) == [f'{{"number":"{n}"}}' for n in (2, 3, 4)]


def test_jdbc_options():
    plain = readers.jdbc_options("jdbc:x:y", table="coins", user="u", password="p")
    assert plain == {"url": "jdbc:x:y", "fetchsize": "10000", "user": "u", "password": "p", "dbtable": "coins"}
    split = readers.jdbc_options("jdbc:x:y", query="select 1", partition_column="id", lower=0, upper=9, partitions=4)
    assert (split["dbtable"], split["numPartitions"], split["upperBound"]) == ("(select 1) q", "4", "9")
    for bad in ({}, {"table": "a", "query": "b"}, {"table": "a", "partition_column": "id"}):
        with pytest.raises(ValueError):
            readers.jdbc_options("jdbc:x:y", **bad)


def test_dimensions(spark):
    raw = spark.sql("select cast(null as string) id, '0xAB' address, 18 decimals, 'S' symbol, 1e21D total_supply, 't' date_time")
    assert tuple(normalise_token_dim(raw).collect()[0]) == ("", "0xab", 18, "S", "1" + "0" * 21, "t")
    quotes = spark.sql("select * from values ('a','A',0.5,date'2019-01-01'),('b','B',0.0,date'2019-01-01'),('c','C',2.0,date'2019-01-02') t(id,symbol,price_us,time)")
    assert [r.id for r in load_price_dim(quotes, "2019-01-01").collect()] == ["a"]
    assert load_price_dim(quotes).count() == 2
