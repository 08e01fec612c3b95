"""Whole runs: the stream, and a warehouse built at once and day by day."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import spine
from ledgerlake.operators.transfers import TRANSFER_TOPIC
from ledgerlake.plans.warehouse import PARSERS, Warehouse
from ledgerlake.sources.sinks import write_table
from ledgerlake.streaming import raw

START = dt.date(2019, 1, 1)
DAYS = [START + dt.timedelta(days=n) for n in range(3)]
PAD = "0x" + "0" * 24


def address(n):
    return "0x" + f"{n:040x}"


def document(number, day, hour, sender, receiver, tokens=10):
    at = dt.datetime.combine(day, dt.time(hour), dt.timezone.utc)
    tx = {"hash": f"0xT{number}", "transactionIndex": "0"}
    log = {"address": address(999), "topics": [TRANSFER_TOPIC, PAD + address(sender)[2:], PAD + address(receiver)[2:]],
           "data": hex(tokens), "blockNumber": str(number), "transactionIndex": "0", "transactionHash": f"0xT{number}"}
    return json.dumps({
        "number": str(number), "timestamp": str(int(at.timestamp())), "hash": f"0xB{number}", "miner": address(7),
        "uncles": [], "transactions": [{
            "base": {**tx, "from": address(sender), "gasPrice": "0x1"},
            "receipt": {"status": "0x1", "gasUsed": "21000", "blockNumber": str(number), "transactionIndex": "0", "transactionHash": f"0xT{number}", "logs": [log]},
            "trace": {"from": address(sender), "to": address(receiver), "value": "0xde0b6b3a7640000",
                      "calls": [{"from": address(sender), "to": address(receiver), "value": "0x1"}]}}]})


def documents():
    for n, day in enumerate(DAYS):
        for i in range(3):
            yield n, document(100 + 10 * n + i, day, 3 * i, sender=i + n, receiver=i + 2 * n + 1, tokens=10 + i)


def test_stream_appends_each_block_once(spark, tmp_path):
    lines = [d for _, d in documents()]
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.log").write_text("\n".join(lines[:6]) + "\n")
    target, checkpoint = f"{tmp_path}/out", f"{tmp_path}/cp"

    def run():
        stream = raw.envelope_stream(raw.raw_stream(spark, str(inbox)))
        raw.append_available(stream, target, checkpoint).awaitTermination()
        return sorted(r.block_number for r in spark.read.parquet(target).collect())

    numbers = [json.loads(d)["number"] for d in lines]
    assert run() == sorted(int(n) for n in numbers[:6])
    (inbox / "b.log").write_text("\n".join(lines[4:] + lines[4:6]) + "\n")
    assert run() == sorted(int(n) for n in numbers)
    assert run() == sorted(int(n) for n in numbers)


def test_merging_stream_loses_no_row(spark, tmp_path):
    """Late, repeated, far-future and undated documents; a batch that runs twice changes nothing."""
    inbox, target, side = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/side"
    inbox.mkdir()
    lines = [d for _, d in documents()]
    old = document(900, dt.date(2018, 6, 1), 3, 1, 2)
    ahead = document(901, dt.date(2090, 1, 1), 3, 1, 2)
    undated = json.dumps({"number": "902", "hash": "0xB902"})
    nameless = json.dumps({"number": "903", "timestamp": "1546300800"})

    def run(name, some):
        (inbox / name).write_text("\n".join(some) + "\n")
        stream = raw.raw_stream(spark, str(inbox))
        raw.merge_available(stream, target, side, f"{tmp_path}/cp").awaitTermination()
        return sorted(r.block_number for r in spark.read.parquet(target).collect())

    numbers = sorted(int(json.loads(d)["number"]) for d in lines)
    assert run("a.log", [*lines[:6], ahead]) == sorted([*numbers[:6], 901])
    assert run("b.log", [*lines[4:], lines[0], old, undated, nameless, nameless]) == sorted([*numbers, 900, 901, 903])
    assert run("c.log", [old, nameless, ahead]) == sorted([*numbers, 900, 901, 903])
    reasons = {(r.block_number, r.reason) for r in spark.read.parquet(side).collect()}
    assert {(900, "late"), (901, "ahead"), (902, "undated")} <= reasons
    assert {n for n, _ in reasons} <= {900, 901, 902}
    batch = raw._hashed(spark.createDataFrame([(d,) for d in [*lines, old]], "info string"))
    before = sorted(map(str, spark.read.parquet(target).collect()))
    raw.merge_batch(batch, 7, target, side, 2, 1)
    raw.merge_batch(batch, 7, target, side, 2, 1)
    assert sorted(map(str, spark.read.parquet(target).collect())) == before


def test_manifest_reads_new_files_only(spark, tmp_path):
    import os

    from ledgerlake.sources import manifest

    root, noted, seen = tmp_path / "raw", f"{tmp_path}/manifest", []
    (root / "local_date=2019-01-01" / "n").mkdir(parents=True)

    def load(lines):
        seen.append(sorted((r.info, os.path.basename(r.file)) for r in lines.collect()))

    def put(name, text):
        (root / "local_date=2019-01-01" / "n" / name).write_text(text)

    assert manifest.load_new_files(spark, str(root), noted, load) == 0
    put("a.log", "1\n2\n")
    put("b.log", "3\n")
    put("c.txt", "not a log\n")
    assert manifest.load_new_files(spark, str(root), noted, load) == 2
    assert manifest.load_new_files(spark, str(root), noted, load) == 0
    put("d.log", "4\n")
    assert manifest.load_new_files(spark, str(root), noted, load, files_per_read=1) == 1
    put("b.log", "3\n5\n")
    os.utime(root / "local_date=2019-01-01" / "n" / "b.log", (2e9, 2e9))
    assert manifest.load_new_files(spark, str(root), noted, load) == 1
    assert seen == [[("1", "a.log"), ("2", "a.log"), ("3", "b.log")], [("4", "d.log")], [("3", "b.log"), ("5", "b.log")]]
    with pytest.raises(ZeroDivisionError):  # a load that fails is not noted
        put("e.log", "6\n")
        manifest.load_new_files(spark, str(root), noted, lambda lines: 1 / 0)
    assert manifest.load_new_files(spark, str(root), noted, load) == 1


def dimensions(spark, root):
    token = spark.createDataFrame([("tok", address(999), 1, "TOK")], "id string, address string, decimals int, token_symbol string")
    price = spark.createDataFrame([(i, Decimal(p), d) for d in DAYS[:2] for i, p in (("tok", 2), ("ethereum", 100))],
                                  "id string, price_us decimal(20,8), transaction_date date")
    write_table(token, f"{root}/dm/token_address")
    write_table(price, f"{root}/dm/token_price")
    tokens = token.select(F.col("address").alias("token_address"))
    write_table(spine.spine_days(tokens, F.lit(DAYS[0]), F.lit(DAYS[-1])), f"{root}/dm/token_list", by=["transaction_date"])
    write_table(spark.createDataFrame([(address(3),)], "address string"), f"{root}/dm/exchange_address")


def rows(w, table):
    df = w.read(table)
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    whole, daily = Warehouse(spark, f"{root}/whole"), Warehouse(spark, f"{root}/daily")
    frame = spark.createDataFrame([(d,) for _, d in documents()], "info string")
    for w in (whole, daily):
        dimensions(spark, w.root)
    whole.load_documents(frame)
    whole.run_ledgers()
    whole.build_metrics()
    for n, day in enumerate(DAYS):
        arrived = f"{root}/raw/local_date={day}/n/p"
        spark.createDataFrame([(d,) for at, d in documents() if at == n], "info string").coalesce(1).write.text(arrived)
        daily.load_raw(f"{root}/raw", day, "*.txt")
        daily.run_ledgers(day)
        daily.build_metrics(day)
    return whole, daily


def test_daily_runs_build_the_same_ledgers(built):
    whole, daily = built
    tables = [f"stage/{t}" for t in PARSERS if t != "uncles"] + ["dwd/token_transaction", "dwd/transaction", "dwd/to_address", "dwd/token_to_address", "dwd/token_from_address"]
    for table in tables:
        assert rows(daily, table) == rows(whole, table), table
    assert whole.read("dwd/transaction").groupBy("transaction_type").count().count() == 3


def test_daily_runs_build_the_same_metrics(built):
    whole, daily = built
    for table in ("volume_day", "amount_day", "trades_day", "new_addresses_day", "volume_month", "trades_week", "native_new_addresses", "avg_volume", "avg_amount", "exchange_in", "exchange_out", "total_addresses_native", "total_addresses_token"):
        assert rows(daily, f"dw/{table}") == rows(whole, f"dw/{table}"), table


def test_running_a_day_again_changes_nothing(built):
    _, daily = built
    tables = ["stage/logs", "dwd/token_transaction", "dwd/transaction", "dwd/token_to_address", "dw/volume_day", "dw/total_addresses_token", "dw/ranking_day", "dw/dormant"]
    before = {t: rows(daily, t) for t in tables}
    daily.run_ledgers(DAYS[-1])
    daily.build_metrics(DAYS[-1])
    assert {t: rows(daily, t) for t in tables} == before
