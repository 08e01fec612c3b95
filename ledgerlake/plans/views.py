"""The given tables seen as ledgers, with the same views as SQL for the oracle.

* transfers: lineitem with its order and part; sender = customer, receiver =
  supplier, token = brand. Lines without discount have no priced amount.
* events: sender = user, receiver = the JSON field ``k``, token = event type.
* blocks: one raw JSON block document per order, built row by row (no grouping,
  so no document grows with the data). Field texts are SQL fragments that both
  engines read; they hold upper case, blanks, missing parts and odd values on
  purpose.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators import calls, entities, parse, totals
from ledgerlake.operators.documents import parse_documents
from ledgerlake.operators.parse import envelope
from ledgerlake.operators.spine import spine_days
from ledgerlake.operators.transfers import TRANSFER_TOPIC
from ledgerlake.session import scratch_path

DAY = "2001-06-30"
EVENT_DAY = "2024-01-15"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- transfers


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = load(spark, sf_dir, "part").select("p_partkey", "p_brand")
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey).join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.col("o_custkey").cast("string").alias("from_address"),
        F.col("l_suppkey").cast("string").alias("to_address"),
        F.col("p_brand").alias("token_address"),
        F.col("l_quantity").cast("decimal(18,2)").alias("value"),
        F.when(F.col("l_discount") > 0, F.col("l_extendedprice").cast("decimal(18,2)")).alias("amount"),
        F.col("l_shipdate").alias("date_time"),
        F.to_date("l_shipdate").alias("transaction_date"),
    )


def _first_last(spark: SparkSession, sf_dir: str, name: str, ts: str):
    dates = load(spark, sf_dir, name).select(F.to_date(ts).alias("d"))
    return dates.agg(F.min("d").alias("d")).scalar(), dates.agg(F.max("d").alias("d")).scalar()


def transfer_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token list, an input table of the warehouse: made once."""
    tokens = load(spark, sf_dir, "part").select(F.col("p_brand").alias("token_address")).distinct()
    listed = lambda: by_date(spine_days(tokens, *_first_last(spark, sf_dir, "lineitem", "l_shipdate")))
    return _staged(spark, sf_dir, "transfer-list", listed)


def exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and customers with a high balance stand for the listed exchange addresses."""
    suppliers = load(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 5000).select(F.col("s_suppkey").alias("key"))
    customers = load(spark, sf_dir, "customer").where(F.col("c_acctbal") > 5000).select(F.col("c_custkey").alias("key"))
    return suppliers.union(customers).select(F.col("key").cast("string").alias("address"))


TRANSFERS_SQL = """t AS (
  SELECT CAST(o_custkey AS VARCHAR) AS from_address, CAST(l_suppkey AS VARCHAR) AS to_address,
         p_brand AS token_address, CAST(l_quantity AS DECIMAL(18,2)) AS value,
         CASE WHEN l_discount > 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount,
         l_shipdate AS date_time, CAST(l_shipdate AS DATE) AS transaction_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

SPINE_SQL = """spine AS (
  SELECT token_address, CAST(d AS DATE) AS transaction_date
  FROM (SELECT DISTINCT p_brand AS token_address FROM part),
       (SELECT unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS d FROM lineitem))"""

EXCHANGES_SQL = """x AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS address FROM supplier WHERE s_acctbal > 5000
  UNION SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 5000)"""

# ------------------------------------------------------------------- events


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    receiver = F.get_json_object("props", "$.k")
    value = F.col("value").cast("decimal(18,2)")
    return load(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("from_address"),
        receiver.alias("to_address"),
        F.col("event_type").alias("token_address"),
        value.alias("value"),
        F.when(receiver.cast("int") % 2 == 0, value * 2).alias("amount"),
        F.col("ts").alias("date_time"),
        F.to_date("ts").alias("transaction_date"),
    )


def event_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = load(spark, sf_dir, "events").select(F.col("event_type").alias("token_address")).distinct()
    return _staged(spark, sf_dir, "event-list", lambda: by_date(spine_days(tokens, *_first_last(spark, sf_dir, "events", "ts"))))


EVENTS_SQL = """e AS (
  SELECT CAST(user_id AS VARCHAR) AS from_address, json_extract_string(props, '$.k') AS to_address,
         event_type AS token_address, CAST(value AS DECIMAL(18,2)) AS value,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) % 2 = 0
              THEN CAST(value AS DECIMAL(18,2)) * 2 END AS amount,
         ts AS date_time, CAST(ts AS DATE) AS transaction_date, strftime(ts, '%H') AS dh
  FROM events)"""

EVENT_SPINE_SQL = """es AS (
  SELECT token_address, CAST(d AS DATE) AS transaction_date
  FROM (SELECT DISTINCT event_type AS token_address FROM events),
       (SELECT unnest(generate_series(CAST(min(CAST(ts AS DATE)) AS TIMESTAMP),
                                      CAST(max(CAST(ts AS DATE)) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM events))"""

# ------------------------------------------------------------------- blocks
# k = order key, c = customer key, np = number of parts (tokens), pc = price in cents, b = block number,
# e = epoch seconds, j = transaction index, i = log or uncle index, n = call node.


def addr(x: str, width: int = 40) -> str:
    return f"concat('0x', lpad(hex({x}), {width}, '0'))"


def text(x: str) -> str:
    return f"cast({x} as string)"


TX_HASH = "concat('0xA', lpad(hex(k * 4 + j), 15, '0'))"
BLOCK_HASH = "concat('0xB', lpad(hex(k), 15, '0'))"
STAMP = f"case when k % 503 = 502 then null when k % 501 = 500 then 'n/a' else {text('e')} end"
RAW_VALUE = "pc * 10000000000"

BLOCK_DOC = {
    "difficulty": "concat('0x', hex(k + 1))",
    "extraData": "'0xDEAD'",
    "gasLimit": "'8000000'",
    "gasUsed": text("k * 13"),
    "hash": BLOCK_HASH,
    "logsBloom": "'0x'",
    "miner": f"concat('  ', {addr('c')}, ' ')",
    "mixHash": "concat('0xE', hex(c))",
    "nonce": text("k"),
    "parentHash": "concat('0xB', lpad(hex(k + 7), 15, '0'))",
    "receiptsRoot": "case when k % 5 > 0 then concat('0xF', hex(k)) end",
    "sha3Uncles": "'0x1DCC'",
    "size": text("500 + k % 100"),
    "stateRoot": "concat('0xAB', hex(k))",
    "totalDifficulty": "k * 10",
    "transactionsRoot": "concat('0xCD', hex(k))",
}
BASE_DOC = {
    "blockHash": BLOCK_HASH,
    "from": addr("c"),
    "gas": "'21000'",
    "gasPrice": "case when k % 13 = 12 then ' ' when j % 2 = 0 then concat('0x', lower(hex(1000000000 * (k % 50 + 1))))"
    f" else {text('1000000000 * (k % 50 + 1)')} end",
    "hash": TX_HASH,
    "input": "'0x'",
    "nonce": text("j"),
    "to": addr("c + j + 1"),
    "transactionIndex": text("j"),
    "value": f"concat('0x', hex({RAW_VALUE}))",
    "v": "'0x1B'",
    "r": "concat('0x', hex(k))",
    "s": "concat('0x', hex(j))",
}
GAS_USED = text("21000 + (k * 31 + j * 7) % 50000")
STATUS = "case (k + j) % 5 when 0 then '0x0' when 1 then 'False' when 2 then '0x1' when 4 then 'true' end"
RECEIPT_MISSING = "k % 17 = 16 and j = 0"
RECEIPT_DOC = {
    "blockHash": BLOCK_HASH,
    "blockNumber": text("b"),
    "contractAddress": "cast(null as string)",
    "cumulativeGasUsed": text("100000 + j"),
    "from": addr("c"),
    "gasUsed": GAS_USED,
    "logsBloom": "'0x0'",
    "root": "concat('0x', hex(b))",
    "status": STATUS,
    "to": addr("c + j + 1"),
    "transactionIndex": text("j"),
    "transactionHash": TX_HASH,
}
LOG_COUNT = "(k + j) % 3"
LOG_TOKEN = "(k * 7 + j * 3 + i) % np"
TOPIC_CASE = "(k + i) % 6"
DATA_CASE = "(k + j + i) % 4"
LOG_DOC = {
    "address": f"concat(' ', {addr(LOG_TOKEN)})",
    "data": f"case {DATA_CASE} when 0 then {addr(RAW_VALUE, 64)} when 1 then {text(RAW_VALUE)} when 2 then '0x'"
    " else concat('0x', hex(pc), lpad(hex(k + 1), 25, '0')) end",
    "blockNumber": text("b"),
    "blockHash": BLOCK_HASH,
    "transactionHash": TX_HASH,
    "transactionIndex": text("j"),
    "logIndex": text("i"),
    "removed": "false",
    "id": "concat('log_', hex(i))",
}
TOPIC_FROM, TOPIC_TO = addr("c", 64), addr("k + i", 64)
TRACE_MISSING = "k % 23 = 22 and j = 1"
TRACE_DOC = {
    "type": "'CALL'",
    "from": addr("c"),
    "to": f"case when k % 19 = 18 then '' else {addr('c + j + 1')} end",
    "value": f"concat('0x', hex({RAW_VALUE} + j))",
    "gas": "'0x5208'",
    "gasUsed": "'0x0'",
    "input": "'0x'",
    "output": "'0xFF'",
    "time": "'12.5MS'",
    "error": "case when (k + j) % 7 = 0 then 'Reverted' end",
}
CALL_SHAPE = "(k + j) % 4"


def call_doc(n: str) -> dict[str, str]:
    return {
        "type": "'CALL'",
        "from": addr(f"c + {n}"),
        "gas": "'0x1'",
        "gasUsed": text(f"1000 + {n}"),
        "to": f"case when {n} <> 2 then {addr(f'k + {n}')} end",
        "value": f"concat('0x', hex({RAW_VALUE} + {n}))",
        "input": "'0x'",
        "output": "'0x'",
        "error": f"case when {n} = 3 then 'Out of gas' end",
    }


UNCLE_DOC = {
    "hash": "case when i = 1 then '' else concat('0xC', hex(k)) end",
    "miner": addr("c + i"),
    "number": text("b - 1 - i"),
    "time": text("e - 10 - i"),
}

# (shape, node, path, parent path, sibling index): the same trees as rows.
CALL_NODES = (
    (1, 0, "0", "0", 0),
    (2, 0, "0", "0", 0),
    (2, 1, "0/0", "0", 0),
    (2, 2, "0/0/0", "0/0", 0),
    (3, 0, "0", "0", 0),
    (3, 1, "0/0", "0", 0),
    (3, 2, "0/1", "0", 1),
    (3, 3, "1", "1", 1),
)


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {sql}" for name, sql in fields.items()) + ")"


def _block_document() -> str:
    leaf = lambda n: _struct(call_doc(n))
    no_leaf = f"cast(null as array<struct<{', '.join(f'`{f}`: string' for f in call_doc('0'))}>>)"
    inner = lambda n, calls: _struct({**call_doc(n), "calls": calls})
    level2 = lambda n: inner(n, no_leaf)
    no_inner = f"slice(array({level2('0')}), 1, 0)"
    chain = f"array({inner('0', f'array({inner('1', f'array({leaf('2')})')})')})"
    wide = f"array({inner('0', f'array({level2('1')}, {level2('2')})')}, {inner('3', no_inner)})"
    single = f"array({inner('0', no_inner)})"
    calls = f"case {CALL_SHAPE} when 1 then {single} when 2 then {chain} when 3 then {wide} end"

    topics = (
        f"case {TOPIC_CASE} when 0 then slice(array(''), 1, 0) when 1 then array('{TRANSFER_TOPIC}')"
        f" when 2 then array('0xBEEF', {TOPIC_FROM}, {TOPIC_TO})"
        f" when 5 then array(upper('{TRANSFER_TOPIC}'), {TOPIC_FROM}, {TOPIC_TO}, '0x07')"
        f" else array('{TRANSFER_TOPIC}', {TOPIC_FROM}, {TOPIC_TO}) end"
    )
    each = lambda count, var, body: f"transform(slice(sequence(0, 3), 1, cast({count} as int)), {var} -> {body})"
    logs = each(LOG_COUNT, "i", _struct({**LOG_DOC, "topics": topics}))
    receipt = f"case when not ({RECEIPT_MISSING}) then {_struct({**RECEIPT_DOC, 'logs': logs})} end"
    trace = f"case when not ({TRACE_MISSING}) then {_struct({**TRACE_DOC, 'calls': calls})} end"
    txs = each("k % 4", "j", _struct({"base": _struct(BASE_DOC), "receipt": receipt, "trace": trace}))
    fields = {
        "number": text("b"),
        "timestamp": STAMP,
        **BLOCK_DOC,
        "uncles": each("k % 3", "i", _struct(UNCLE_DOC)),
        "transactions": f"case when k % 8 > 0 then {txs} end",
    }
    return f"to_json({_struct(fields)})"


def part_count(spark: SparkSession, sf_dir: str) -> Column:
    return load(spark, sf_dir, "part").agg(F.count("*").alias("np")).scalar()


BY_KEY = {"_by": "k"}


def block_documents(spark: SparkSession, sf_dir: str, *keep: str, by: Mapping[str, str] = BY_KEY) -> DataFrame:
    """Raw documents in column ``info``; of the other columns those that ``keep`` names.

    The orders may come in few files; the small seed rows are spread before the
    documents are built, over the columns of ``by`` and in their order, so that
    no document has to be shuffled or sorted.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    orders = load(spark, sf_dir, "orders").withColumn("np", part_count(spark, sf_dir))
    seeds = orders.selectExpr(
        "np",
        "o_orderkey as k",
        "o_custkey as c",
        "cast(round(o_totalprice * 100) as bigint) as pc",
        "4365000 + o_orderkey * 200 as b",
        "datediff(to_date(o_orderdate), date'1970-01-01') * 86400L + (o_orderkey * 37) % 86400 as e",
        "to_date(o_orderdate) as d",
    )
    spread = seeds.selectExpr("*", *[f"{key} as {name}" for name, key in by.items()]).repartition(tasks, *by)
    return spread.sortWithinPartitions(*by).selectExpr(f"{_block_document()} as info", *keep)


_STAGED: dict[tuple[str, str, str], str] = {}


def _staged(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table made from the given ones, written once per application to the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGED:
        path = scratch_path(spark, name)
        build().write.parquet(path, compression="zstd")
        _STAGED[key] = path
    return spark.read.parquet(_STAGED[key])


def source_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The envelope table of the documents."""
    return _staged(spark, sf_dir, "source", lambda: envelope(block_documents(spark, sf_dir)))


PARSERS = {
    "block": parse.parse_blocks,
    "base": parse.parse_transactions,
    "receipt": parse.parse_receipts,
    "logs": parse.parse_logs,
    "trace": parse.parse_traces,
    "calls": calls.flatten_calls,
    "uncles": parse.parse_uncles,
}


def document_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as one nested table: the raw text is parsed here alone, as it comes, and not kept."""
    return _staged(spark, sf_dir, "documents", lambda: parse_documents(envelope(block_documents(spark, sf_dir))))


def part_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parsed tables of the documents: a scan of its own columns of the nested table."""
    return PARSERS[name](document_table(spark, sf_dir))


def by_date(df: DataFrame) -> DataFrame:
    """Rows of neighbouring dates in the same files, so that a range of dates skips the others."""
    return df.repartitionByRange("transaction_date").sortWithinPartitions("transaction_date")


def first_seen_table(
    spark: SparkSession, sf_dir: str, keys: tuple[str, ...], sides: tuple[str, ...] = entities.BOTH_SIDES, view: str = "transfers"
) -> DataFrame:
    """The first-seen table that daily runs keep, as it stands after all of history."""
    ledger = {"transfers": transfers, "events": events}[view]
    name = "-".join(("seen", view, *keys, *sides))
    return _staged(spark, sf_dir, name, lambda: by_date(entities.first_seen(ledger(spark, sf_dir), keys, sides)))


def total_table(spark: SparkSession, sf_dir: str, per_token: bool) -> DataFrame:
    """The running totals that daily runs keep."""
    if per_token:
        seen = first_seen_table(spark, sf_dir, ("token_address",))
        build = lambda: by_date(totals.running_total_by_token(seen, transfer_spine(spark, sf_dir)))
        return _staged(spark, sf_dir, "total-token", build)
    seen = first_seen_table(spark, sf_dir, ())
    return _staged(spark, sf_dir, "total-native", lambda: totals.running_total(seen))


BLOCKS_SQL = """seed AS (
  SELECT o_orderkey AS k, o_custkey AS c, CAST(round(o_totalprice * 100) AS BIGINT) AS pc,
         4365000 + o_orderkey * 200 AS b,
         date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 86400 + (o_orderkey * 37) % 86400 AS e,
         (SELECT count(*) FROM part) AS np
  FROM orders),
jt AS (
  SELECT *, strftime(date_time, '%H') AS dh, CAST(date_time AS DATE) AS transaction_date
  FROM (SELECT *, CASE WHEN k % 503 <> 502 AND k % 501 <> 500 THEN make_timestamp(e * 1000000) END AS date_time FROM seed)),
tx AS (SELECT * FROM jt, unnest(range(k % 4)) AS u(j)),
lg AS (SELECT * FROM tx, unnest(range((k + j) % 3)) AS u(i) WHERE NOT (k % 17 = 16 AND j = 0))"""


def token_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select(
        F.concat(F.lit("tok-"), F.col("p_partkey").cast("string")).alias("id"),
        F.expr(f"lower({addr('p_partkey')})").alias("address"),
        (F.col("p_partkey") % 19).cast("int").alias("decimals"),
        F.col("p_brand").alias("token_symbol"),
    )


TOKENS_SQL = f"""tok AS (
  SELECT concat('tok-', CAST(p_partkey AS VARCHAR)) AS id, lower({addr('p_partkey')}) AS address,
         p_partkey % 19 AS decimals, p_brand AS token_symbol FROM part)"""


def token_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest order price per token and day, as a table; a third of the orders sets none."""
    quotes = load(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0").withColumn("np", part_count(spark, sf_dir))
    token = F.expr("concat('tok-', cast((o_orderkey * 7) % np as string))")
    return _staged(spark, sf_dir, "token-price", lambda: _highest_price(quotes, token))


def _highest_price(quotes: DataFrame, asset: Column) -> DataFrame:
    return quotes.groupBy(asset.alias("id"), F.to_date("o_orderdate").alias("transaction_date")).agg(
        F.max(F.col("o_totalprice").cast("decimal(18,2)")).alias("price_us")
    )


TOKEN_PRICES_SQL = """pr AS (
  SELECT concat('tok-', CAST((o_orderkey * 7) % (SELECT count(*) FROM part) AS VARCHAR)) AS id, CAST(o_orderdate AS DATE) AS transaction_date,
         max(CAST(o_totalprice AS DECIMAL(18,2))) AS price_us
  FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY ALL)"""


def native_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest order price per day for two assets, as a table; many days have none."""
    quotes = load(spark, sf_dir, "orders")
    asset = F.expr("case when o_orderkey % 5 = 0 then 'ethereum' else 'other' end")
    return _staged(spark, sf_dir, "native-price", lambda: _highest_price(quotes, asset))


NATIVE_PRICES_SQL = """np AS (
  SELECT CAST(o_orderdate AS DATE) AS transaction_date, max(CAST(o_totalprice AS DECIMAL(18,2))) AS price_us
  FROM orders WHERE o_orderkey % 5 = 0 GROUP BY ALL)"""
