import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import calls, parse
from ledgerlake.sources.readers import scan


def nested(depth):
    node = {"type": "CALL", "from": "0xAA", "to": "0xBB", "value": "0x1"}
    for _ in range(depth - 1):
        node = {"type": "CALL", "from": "0xAA", "to": "0xBB", "value": "0x1", "calls": [node]}
    return [node]


BASE = {"hash": " 0xT1 ", "transactionIndex": 0, "from": "0xF", "to": "0x2", "gasPrice": "0x2", "blockHash": "0xBB"}
DOCUMENTS = [
    {"number": "1", "timestamp": "1546300800", "hash": "0xB1", "miner": " 0xABC ", "difficulty": 17},
    {"number": "2", "timestamp": "1546300799", "transactions": [], "uncles": []},
    {"number": "3", "timestamp": "1546304400", "transactions": None, "uncles": [{"hash": ""}, {"hash": "0xU", "time": "1546300000", "number": "2"}]},
    {"number": "4", "timestamp": "soon", "transactions": [{"base": BASE}]},
    {
        "number": "0x5",
        "timestamp": "1546308000",
        "transactions": [
            {"base": BASE, "receipt": {"status": "0x0", "gasUsed": "21000", "blockNumber": "5", "logs": [
                {"address": "0xTOK", "topics": ["0xAa", "0xBb"], "data": "0x", "blockNumber": "5", "removed": False},
                {"address": "0xTOK", "topics": [], "blockNumber": "5"},
                {"address": "0xTOK", "blockNumber": "5"}]}},
            {"base": BASE, "receipt": {"status": "FALSE"}, "trace": {"error": " Reverted ", "calls": []}},
            {"base": BASE, "receipt": {"status": "0x1", "logs": []}, "trace": {"type": "CALL", "calls": nested(1024)}},
            {"base": BASE, "trace": {"calls": [
                {"from": "0x1", "calls": [{"from": "0x2"}, {"from": "0x3", "value": 7}]}, {"from": "0x4"}]}},
        ],
    },
]


@pytest.fixture(scope="module")
def source(spark):
    rows = [(json.dumps(d),) for d in DOCUMENTS]
    return parse.envelope(spark.createDataFrame(rows, "info string"))


def column(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]


def test_envelope(source):
    got = column(source.orderBy("block_number"), "block_number", "dh", "date_time", "transaction_date")
    assert got[0] == (1, "00", dt.datetime(2019, 1, 1), dt.date(2019, 1, 1))
    assert got[1] == (2, "23", dt.datetime(2018, 12, 31, 23, 59, 59), dt.date(2018, 12, 31))
    assert got[3] == (4, None, None, None)
    assert got[4][0] == 5


def test_blocks_keep_every_document(source):
    got = {r.block_number: r for r in parse.parse_blocks(source).collect()}
    assert len(got) == 5
    assert (got[1].miner, got[1].block_hash, got[1].difficulty, got[1].nonce) == ("0xabc", "0xb1", "17", "")


def test_transactions(source):
    got = column(parse.parse_transactions(source), "block_number", "base_transaction_hash", "base_gas_used", "base_v")
    assert sorted(got) == [(4, "0xt1", "", "")] + sorted([(5, "0xt1", "21000", "")] + [(5, "0xt1", "", "")] * 3)


def test_receipt_status(source):
    got = column(parse.parse_receipts(source), "receipt_status", "block_number")
    assert sorted(got, key=str) == sorted([("", None), ("", None), ("false", 5), ("false", None), ("true", None)], key=str)


def test_logs(source):
    got = column(parse.parse_logs(source), "logs_address", "logs_topics", "logs_topics_one", "logs_data", "logs_removed")
    assert sorted(got) == sorted([
        ("0xtok", '["0xaa","0xbb"]', "0xaa", "0x", "false"), ("0xtok", "", "", "", ""), ("0xtok", "", "", "", "")])


def test_traces_without_trace_have_no_error(source):
    assert sorted(column(parse.parse_traces(source), "trace_error", "trace_transaction_index")) == [
        ("", "0")] * 4 + [("reverted", "0")]


def test_call_tree(source):
    flat = calls.flatten_calls(source)
    rows = flat.collect()
    assert len(rows) == 1024 + 4
    small = {r.calls_id: r for r in rows if r.calls_from in ("0x1", "0x2", "0x3", "0x4")}
    shape = {i: (r.calls_parent_id, r.calls_index, r.calls_from) for i, r in small.items()}
    assert shape == {
        "0xt1/0": ("0xt1/0", "0", "0x1"),
        "0xt1/0/0": ("0xt1/0", "0", "0x2"),
        "0xt1/0/1": ("0xt1/0", "1", "0x3"),
        "0xt1/1": ("0xt1/1", "1", "0x4"),
    }
    assert small["0xt1/0/1"].calls_value == "7"
    assert max(r.calls_id.count("/") for r in rows) == 1024


def test_call_tree_flushes_large_trees(source, monkeypatch):
    whole = sorted(map(tuple, calls.flatten_calls(source).collect()), key=str)
    monkeypatch.setattr(calls, "_FLUSH_ROWS", 7)
    assert sorted(map(tuple, calls.flatten_calls(source).collect()), key=str) == whole


def nested(levels):
    tree = "[]"
    for _ in range(levels):
        tree = '[{"from":"0xa","calls":' + tree + "}]"
    return '{"number":"1","timestamp":"1","transactions":[{"base":{"hash":"0xT"},"trace":{"calls":' + tree + "}}]}"


def test_malformed_documents_give_what_they_hold(spark):
    documents = [
        '{"number":"1","timestamp":"1","transactions":"oops"}',
        '{"number":"2","timestamp":"1","transactions":[null,{"base":"x"},{"base":{"hash":"0xG"},"trace":{"calls":[{"from":"0xF"},7]}}]}',
        '{"number":"3","timestamp":"1","transactions":[{"base":{"hash":"0xH"},"trace":"x"}]}',
        '{"base":{"x"}',
        "no json",
        '{"number":"4","transactions":[]}',
        None,
        nested(20_000),
    ]
    envelope = parse.envelope(spark.createDataFrame([(x,) for x in documents], "info string"))
    got = calls.flatten_calls(envelope)
    counts = {r.calls_transaction_hash: r["count"] for r in got.groupBy("calls_transaction_hash").count().collect()}
    assert counts == {"0xg": 2, "0xt": 20_000}
    kept = calls.quarantine(envelope).groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in kept} == {"transactions": 1, "undated": 2, "no object": 2}


def test_exclude_senders(source):
    flat = calls.flatten_calls(source)
    assert calls.exclude_senders(flat, ["0xAA"]).count() == 4
    assert calls.exclude_senders(flat, []).count() == 1028


def test_uncles_need_a_hash(source):
    assert column(parse.parse_uncles(source), "uncles_hash", "uncles_time", "block_number") == [
        ("0xu", dt.datetime(2018, 12, 31, 23, 46, 40), 3)]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_results_do_not_depend_on_the_session_time_zone(spark, source, zone):
    shown = lambda df: sorted(map(str, df.select("block_number", "dh", F.col("date_time").cast("string"), "transaction_date").collect()))
    scanned = lambda: spark.createDataFrame([(json.dumps(d),) for d in DOCUMENTS], "info string")
    want = shown(source)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        again = parse.envelope(scanned())
        assert shown(again) == want
        assert shown(scan(again, on="2019-01-01", column="date_time")) == shown(again.where("transaction_date = date'2019-01-01'"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_nested_table_gives_what_the_text_gives(spark, source, tmp_path):
    """One parse for all parts, malformed and very deep documents included; each part reads its own columns."""
    from ledgerlake.operators import documents
    from ledgerlake.plans.warehouse import PARSERS

    odd = ["", "{}", "[1]", "no json", '{"number": "9", "timestamp": "1546300800", "transactions": 5, "uncles": {}}',
           '{"number": "8", "timestamp": "1546300800", "transactions": [null, 7, {"base": [], "receipt": {"logs": "x"}, "trace": {"calls": 3}}]}',
           '{"number": "7", "timestamp": "1546300800", "transactions": [{"base": {"hash": "0xD"}, "trace": {"calls": %s}}], "miner": "0xDEEP"}' % (
               '[{"calls":' * 3000 + "[]" + "}]" * 3000)]
    rows = source.select("info").unionByName(spark.createDataFrame([(x,) for x in odd], "info string"))
    whole = parse.envelope(rows)
    documents.parse_documents(whole).write.parquet(f"{tmp_path}/nested")
    nested = spark.read.parquet(f"{tmp_path}/nested")
    for name, parser in PARSERS.items():
        assert sorted(map(str, parser(nested).collect())) == sorted(map(str, parser(whole).collect())), name
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = parse.parse_receipts(nested)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scanned = plan[plan.index("ReadSchema"):]
    assert "cumulativeGasUsed" in scanned and "logs:" not in scanned and "trees" not in scanned and "extraData" not in scanned
