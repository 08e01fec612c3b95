import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import metrics, native, transfers

DAY = dt.date(2019, 1, 1)
NOON = dt.datetime(2019, 1, 1, 12)
LOG = "block_number bigint, logs_address string, logs_topics string, logs_topics_one string, logs_data string, logs_transaction_index string, logs_transaction_hash string, date_time timestamp_ntz, transaction_date date"
SIG = transfers.TRANSFER_TOPIC
PAD = "0x" + "0" * 24


def log(topics, data="0x0a", address="0xtok", tx="0xt1", first=SIG):
    return (5, address, "[" + ",".join(f'"{t}"' for t in topics) + "]" if topics else "", first, data, "0", tx, NOON, DAY)


FULL = [SIG, PAD + "a" * 40, PAD + "b" * 40]
RECEIPT = "block_number bigint, transaction_date date, receipt_transaction_index string, receipt_transaction_hash string, receipt_status string"
TRACE = "block_number bigint, transaction_date date, trace_transaction_index string, trace_transaction_hash string, trace_error string"
TOKEN = "id string, address string, decimals int, token_symbol string"
PRICE = "id string, price_us decimal(20,8), transaction_date date"


@pytest.fixture(scope="module")
def tokens(spark):
    return spark.createDataFrame([("a", "0xtok", 1, "A"), ("", "0xnone", 0, "N")], TOKEN)


def test_select(spark, tokens):
    rows = [log(FULL), log(FULL + ["0x7"]), log(FULL[:2]), log([]), log(FULL, address="0xother"), log(FULL, address=""), log(FULL, first="0x1")]
    assert transfers.select_transfer_logs(spark.createDataFrame(rows, LOG), tokens).count() == 2


def test_decode(spark):
    words = ["0x" + "0" * 62 + "ff", "25", "0x", "0x" + "f" * 64]
    got = transfers.decode_transfers(spark.createDataFrame([log(FULL, w) for w in words], LOG)).collect()
    assert {(r.from_address, r.to_address) for r in got} == {("0x" + "a" * 40, "0x" + "b" * 40)}
    assert [r.value for r in got] == ["255", "25", None, str(2**256 - 1)]


def test_valid_is_safe_against_duplicates_and_equals_the_inner_join_on_unique_keys(spark):
    names = ["0xt1", "0xt2", "0xt3", "0xt4"]
    moves = transfers.decode_transfers(spark.createDataFrame([log(FULL, tx=t) for t in names + ["0xt1"]], LOG))
    receipts = spark.createDataFrame([(5, DAY, "0", t, s) for t, s in zip(names, ["true", "false", "", "true"])], RECEIPT)
    traces = spark.createDataFrame([(5, DAY, "0x0", t, e) for t, e in zip(names, ["", "", "", "bad"])], TRACE)
    once = transfers.valid_transfers(moves, receipts, traces)
    assert sorted(r.logs_transaction_hash for r in once.collect()) == ["0xt1", "0xt1", "0xt3"]
    twice = transfers.valid_transfers(moves, receipts.union(receipts), traces.union(traces))
    assert sorted(twice.collect()) == sorted(once.collect())
    inner = moves.join(receipts.where("receipt_status <> 'false'"), moves.logs_transaction_hash == receipts.receipt_transaction_hash)
    inner = inner.join(traces.where("trace_error = ''"), inner.logs_transaction_hash == traces.trace_transaction_hash)
    assert inner.count() == once.count()


def test_enrich(spark, tokens):
    moves = transfers.decode_transfers(spark.createDataFrame(
        [log(FULL, "25"), log(FULL, "0x"), log(FULL, "0x" + "f" * 64), log(FULL, "7", address="0xnone")], LOG))
    prices = spark.createDataFrame([("a", Decimal("0.00000003"), DAY)], PRICE)
    got = {r.value: r for r in transfers.enrich_transfers(moves, tokens, prices).collect()}
    assert got["2.5"].amount == "0.000000075"
    assert got[None].amount is None
    widest, product = str(2**256 - 1), str(3 * (2**256 - 1))
    assert got[f"{widest[:-1]}.{widest[-1]}"].amount == f"{product[:-9]}.{product[-9:]}"
    assert (got["7"].price_us, got["7"].amount, got["7"].token_symbol) == (None, None, "N")
    assert got["7"].dh == "12"


def test_widest_word_reaches_the_metrics(spark, tokens):
    """A 256-bit value is counted whole in volume, amount and averages."""
    moves = transfers.decode_transfers(spark.createDataFrame([log(FULL, "0x" + "f" * 64), log(FULL, "25")], LOG))
    prices = spark.createDataFrame([("a", Decimal("2"), DAY)], PRICE)
    ledger = transfers.enrich_transfers(moves, tokens, prices)
    listed = ledger.select("token_address", "transaction_date").distinct()
    whole = Decimal(2**256 - 1 + 25).scaleb(-1)
    for measure, want in (("volume", whole), ("amount", whole * 2)):
        for got in (metrics.rollup_metric(ledger, listed, measure), metrics.rollup_grains(ledger, listed, measure)):
            assert {r.value_num for r in got.collect()} == {float(want)}
    assert [r.value_num for r in metrics.avg_metric(ledger, listed).collect()] == [float(whole) / 2]


def test_reward_heights(spark):
    heights = [0, 4369999, 4370000, 7080000, 7080001]
    df = spark.createDataFrame([(h,) for h in heights], "h bigint")
    got = [r[0] for r in df.select(native.step_lookup(F.col("h"), native.REWARD_STEPS)).collect()]
    assert got == [5, 5, 3, 3, 2]


UNCLE = "block_number bigint, uncles_miner string, uncles_number string, date_time timestamp_ntz, transaction_date date"
BLOCK = "block_number bigint, miner string, date_time timestamp_ntz, transaction_date date"


def test_rewards_and_fees(spark):
    blocks = spark.createDataFrame([(10, "0xm", NOON, DAY), (7080001, "0xm", NOON, DAY)], BLOCK)
    uncles = spark.createDataFrame([(10, "0xu", "9", NOON, DAY), (10, "0xu", "8", NOON, DAY)], UNCLE)
    base = spark.createDataFrame([(10, "21000", "0x3b9aca00"), (10, "21000", "1000000000"), (10, "", "5"), (10, "5", "")],
                                 "block_number bigint, base_gas_used string, base_gas_price string")
    fees = native.block_fees(base)
    assert fees.collect()[0].service_charge == "0.000042"
    assert sorted(r.value for r in native.uncle_rewards(uncles).collect()) == ["3.75", "4.375"]
    got = {r.block_number: r for r in native.block_rewards(blocks, uncles, fees).collect()}
    assert got[10].value == "5.312542"
    assert got[7080001].value == "2"
    wide = spark.createDataFrame([(11, "3", "9" * 60), (11, "2", "1.5")], base.schema)
    assert native.block_fees(wide).collect()[0].service_charge == "3" + "0" * 42  # 3e60 wei
    assert got[10].from_address == "0x^0"


MOVE = "block_number bigint, trace_from string, trace_to string, trace_value string, trace_error string, trace_transaction_index string, trace_transaction_hash string, date_time timestamp_ntz, transaction_date date"


def test_movements_and_pricing(spark):
    rows = [(1, "0xa", "0xb", v, e, "0", "0xt", NOON, DAY) for v, e in (("0xde0b6b3a7640000", ""), ("2.5", ""), ("0x", ""), ("0x1", "bad"))]
    rows += [(1, "", "0xb", "0x1", "", "0", "0xt", NOON, DAY), (1, "0xa", "", "0x1", "", "0", "0xt", NOON, DAY)]
    moves = native.trace_movements(spark.createDataFrame(rows, MOVE))
    assert [r.value for r in moves.collect()] == ["1", "2.5", None]
    prices = spark.createDataFrame([("ethereum", Decimal("100.5"), DAY), ("other", Decimal(1), DAY)], PRICE)
    priced = native.price_ledger(moves, prices).collect()
    assert [r.amount for r in priced] == ["100.5", "251.25", None]
    unpriced = native.price_ledger(moves, prices.where("id = 'other'")).collect()
    assert [(r.price_us, r.amount) for r in unpriced][:2] == [(Decimal(0), "0")] * 2
