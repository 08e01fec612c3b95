"""What queries over the block documents leave on disk on their way."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import catalog, source_queries
from ledgerlake.plans import views as V
from ledgerlake.session import scratch_path

ORDERS = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz"
JUNE = dt.datetime(2001, 6, 12)


@pytest.fixture()
def small(spark, tmp_path):
    rows = [(k, k % 50, 1000.0 + k % 9, JUNE + dt.timedelta(days=k % 40)) for k in range(1, 1201)]
    spark.createDataFrame(rows, ORDERS).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(1, 40).selectExpr("id as p_partkey", "'b' as p_brand").write.parquet(str(tmp_path / "part.parquet"))
    return str(tmp_path)


@pytest.fixture()
def written(monkeypatch):
    """Folders made in the shared folder, by name."""
    found = {}

    def noted(spark, name):
        found[name] = scratch_path(spark, name)
        return found[name]

    for module in (V, source_queries):
        monkeypatch.setattr(module, "scratch_path", noted)
    return found


def size(spark, path):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.sum("length")).first()[0]


def test_raw_lines_are_kept_compressed(spark, small, written):
    got = catalog.QUERIES["raw_json_lines"](spark, small).count()
    lines = spark.read.option("recursiveFileLookup", "true").text(written["raw"])
    assert lines.count() == 1200
    dated = V.block_documents(spark, small, f"{source_queries.ARRIVAL} as day")
    near = dated.where("day between date'2001-06-30' and date'2001-07-02'")
    assert 0 < got <= near.count()
    assert 3 * size(spark, written["raw"]) < lines.agg(F.sum(F.octet_length("value"))).first()[0]


@pytest.mark.parametrize("name", ["native_ledger", "movements", "block_rewards", "transfer_valid", "ledger_priced"])
def test_documents_are_kept_once_and_no_text_of_them(spark, small, written, name):
    catalog.QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
    kept = {n: spark.read.parquet(path) for n, path in written.items() if n != "native-price"}
    assert list(kept) == ["documents"]
    assert "info" not in kept["documents"].columns
    assert 6 * size(spark, written["documents"]) < V.block_documents(spark, small).agg(F.sum(F.octet_length("info"))).first()[0]
