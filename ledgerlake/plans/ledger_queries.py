"""Parse and ledger queries over the block documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake.operators import calls as C
from ledgerlake.operators import native, parse, transfers
from ledgerlake.plans import views as V
from ledgerlake.plans.registry import register

B = V.BLOCKS_SQL
TIMES = "dh, CAST(date_time AS VARCHAR) AS date_time, CAST(transaction_date AS VARCHAR) AS transaction_date"


_source = V.source_table


def _clean(x: str) -> str:
    return f"lower(trim(coalesce(CAST({x} AS VARCHAR), '')))"


def _columns(fields: dict[str, str], doc: dict[str, str], missing: str | None = None) -> str:
    """Expected columns of a part of the document; empty text where the part is missing."""
    value = lambda sql: _clean(sql if missing is None else f"CASE WHEN NOT ({missing}) THEN {sql} END")
    return ", ".join(f"{value(doc[field])} AS {column}" for field, column in fields.items())


# ---------------------------------------------------------------------- parse

register(
    "json_envelope",
    lambda spark, sf: parse.envelope(V.block_documents(spark, sf)).drop("info"),
    f"WITH {B} SELECT b AS block_number, {TIMES} FROM jt",
)
register(
    "parse_blocks",
    lambda spark, sf: parse.parse_blocks(_source(spark, sf)),
    f"WITH {B} SELECT {_columns(S.BLOCK_FIELDS, V.BLOCK_DOC)}, b AS block_number, {TIMES} FROM jt",
)
register(
    "parse_transactions",
    lambda spark, sf: parse.parse_transactions(_source(spark, sf)),
    f"""WITH {B} SELECT {_columns(S.BASE_FIELDS, V.BASE_DOC)},
    {_columns({'gasUsed': 'base_gas_used'}, V.RECEIPT_DOC, V.RECEIPT_MISSING)}, b AS block_number, {TIMES} FROM tx""",
)
_STATUS_SQL = f"""CASE WHEN {V.RECEIPT_MISSING} OR (k + j) % 5 = 3 THEN ''
  WHEN (k + j) % 5 < 2 THEN 'false' ELSE 'true' END"""
register(
    "parse_receipts",
    lambda spark, sf: parse.parse_receipts(_source(spark, sf)).withColumn(
        "block_number", F.col("block_number").cast("string")
    ),
    f"""WITH {B} SELECT {_columns(S.RECEIPT_FIELDS, V.RECEIPT_DOC, V.RECEIPT_MISSING)},
    {_STATUS_SQL} AS receipt_status, CASE WHEN NOT ({V.RECEIPT_MISSING}) THEN CAST(b AS VARCHAR) END AS block_number, {TIMES} FROM tx""",
)
_TOPIC, _PAIR = V.TRANSFER_TOPIC, f"""lower(concat('","', {V.TOPIC_FROM}, '","', {V.TOPIC_TO}))"""
_TOPICS_SQL = f"""CASE {V.TOPIC_CASE} WHEN 0 THEN '' WHEN 1 THEN '["{_TOPIC}"]'
  WHEN 2 THEN concat('["0xbeef', {_PAIR}, '"]') WHEN 5 THEN concat('["{_TOPIC}', {_PAIR}, '","0x07"]')
  ELSE concat('["{_TOPIC}', {_PAIR}, '"]') END"""
register(
    "parse_logs",
    lambda spark, sf: parse.parse_logs(_source(spark, sf)),
    f"""WITH {B} SELECT {_columns(S.LOG_FIELDS, V.LOG_DOC)}, {_TOPICS_SQL} AS logs_topics,
    CASE {V.TOPIC_CASE} WHEN 0 THEN '' WHEN 2 THEN '0xbeef' ELSE '{_TOPIC}' END AS logs_topics_one,
    b AS block_number, {TIMES} FROM lg""",
)
register(
    "parse_traces",
    lambda spark, sf: parse.parse_traces(_source(spark, sf)),
    f"""WITH {B} SELECT {_columns(S.TRACE_FIELDS, V.TRACE_DOC, V.TRACE_MISSING)}, b AS block_number,
    CAST(j AS VARCHAR) AS trace_transaction_index, lower({V.TX_HASH}) AS trace_transaction_hash, {TIMES} FROM tx""",
)
_NODES = ", ".join(str(node) for node in V.CALL_NODES)
_CALLS_SQL = f"""nd AS (SELECT * FROM (VALUES {_NODES}) AS v(shape, n, path, parent, sibling)),
cl AS (
  SELECT concat(lower({V.TX_HASH}), '/', path) AS calls_id, concat(lower({V.TX_HASH}), '/', parent) AS calls_parent_id,
    CAST(sibling AS VARCHAR) AS calls_index, {_columns(S.CALL_FIELDS, V.call_doc('n'))}, b AS block_number,
    CAST(j AS VARCHAR) AS calls_transaction_index, lower({V.TX_HASH}) AS calls_transaction_hash,
    dh, date_time, transaction_date, pc, n
  FROM tx JOIN nd ON {V.CALL_SHAPE} = shape WHERE NOT ({V.TRACE_MISSING}))"""
_CALLS_OUT = f"""SELECT calls_id, calls_parent_id, calls_index, {', '.join(S.CALL_FIELDS.values())}, block_number,
  calls_transaction_index, calls_transaction_hash, {TIMES} FROM cl"""
register(
    "flatten_calls",
    lambda spark, sf: C.flatten_calls(_source(spark, sf)),
    f"WITH {B}, {_CALLS_SQL} {_CALLS_OUT}",
)
SENDERS = [f"0x{number:040X}" for number in (1, 10, 100)]
register(
    "exclude_senders",
    lambda spark, sf: C.exclude_senders(V.part_table(spark, sf, "calls"), SENDERS),
    f"WITH {B}, {_CALLS_SQL} {_CALLS_OUT} WHERE calls_from NOT IN ({', '.join(repr(s.lower()) for s in SENDERS)})",
)
_UNCLES_SQL = f"""un AS (
  SELECT b AS block_number, {_columns(S.UNCLE_FIELDS, V.UNCLE_DOC)}, make_timestamp((e - 10 - i) * 1000000) AS uncles_time,
    dh, date_time, transaction_date
  FROM (SELECT * FROM jt, unnest(range(k % 3)) AS u(i)) WHERE i <> 1)"""
register(
    "parse_uncles",
    lambda spark, sf: parse.parse_uncles(_source(spark, sf)),
    f"""WITH {B}, {_UNCLES_SQL} SELECT block_number, uncles_hash, uncles_miner, uncles_number,
    CAST(uncles_time AS VARCHAR) AS uncles_time, {TIMES} FROM un""",
)

# ---------------------------------------------------------------- SQL for exact numbers

E18 = "1000000000000000000"


def scaled_sql(digits: str, places: str) -> str:
    """Whole number divided by 10^places, as plain text."""
    s = f"CAST({digits} AS VARCHAR)"
    wide = f"lpad({s}, CAST(greatest(length({s}), {places} + 1) AS INT), '0')"
    return (
        f"rtrim(rtrim(concat(left({wide}, CAST(length({wide}) - {places} AS INT)), '.',"
        f" right({wide}, CAST({places} AS INT))), '0'), '.')"
    )


E19 = "10000000000000000000"


def product_sql(whole: str, cents: str) -> str:
    """Digits of a whole number of up to 38 digits times a small one; the product may be longer."""
    low = f"(CAST({whole} AS HUGEINT) % {E19} * {cents})"
    high = f"(CAST({whole} AS HUGEINT) // {E19} * {cents} + {low} // {E19})"
    rest = f"CAST({low} % {E19} AS VARCHAR)"
    return f"CASE WHEN {high} > 0 THEN concat(CAST({high} AS VARCHAR), lpad({rest}, 19, '0')) ELSE {rest} END"


def amount_sql(source: str, whole: str = "u", cents: str = "pcent", places: str = "18") -> str:
    """Adds ``amount`` = whole / 10^places x cents / 100 as exact text."""
    return f"""(SELECT *, CASE WHEN product IS NOT NULL THEN {scaled_sql('product', f'({places} + 2)')} END AS amount
    FROM (SELECT *, {product_sql(whole, cents)} AS product FROM {source}))"""


# ------------------------------------------------------------- token transfers


def _selected(spark: SparkSession, sf: str) -> DataFrame:
    return transfers.select_transfer_logs(V.part_table(spark, sf, "logs"), V.token_dim(spark, sf))


def _decoded(spark: SparkSession, sf: str) -> DataFrame:
    return transfers.decode_transfers(_selected(spark, sf))


def _valid(spark: SparkSession, sf: str) -> DataFrame:
    return transfers.valid_transfers(_decoded(spark, sf), V.part_table(spark, sf, "receipt"), V.part_table(spark, sf, "trace"))


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return transfers.enrich_transfers(_valid(spark, sf), V.token_dim(spark, sf), V.token_prices(spark, sf))


_SELECT_SQL = f"""{V.TOKENS_SQL},
sel AS (
  SELECT *, {_clean(V.LOG_DOC['address'])} AS logs_address, {_TOPICS_SQL} AS logs_topics,
    {_clean(V.LOG_DOC['data'])} AS logs_data, lower({V.TX_HASH}) AS logs_transaction_hash,
    CAST(j AS VARCHAR) AS logs_transaction_index, b AS block_number,
    lower({V.addr('c')}) AS from_address, lower({V.addr('k + i')}) AS to_address,
    CASE {V.DATA_CASE} WHEN 2 THEN NULL
      WHEN 3 THEN CAST(pc AS HUGEINT) * CAST(1267650600228229401496703205376 AS HUGEINT) + k + 1
      ELSE CAST({V.RAW_VALUE} AS HUGEINT) END AS raw
  FROM lg WHERE {V.TOPIC_CASE} >= 3 AND {_clean(V.LOG_DOC['address'])} IN (SELECT address FROM tok))"""
_VALID_SQL = f"""{_SELECT_SQL},
val AS (SELECT * FROM sel WHERE {_STATUS_SQL} <> 'false' AND (({V.TRACE_MISSING}) OR (k + j) % 7 <> 0)
        AND transaction_date IS NOT NULL)"""
register(
    "transfer_select",
    _selected,
    f"""WITH {B}, {_SELECT_SQL} SELECT {_columns(S.LOG_FIELDS, V.LOG_DOC)}, logs_topics,
    '{_TOPIC}' AS logs_topics_one, block_number, {TIMES} FROM sel""",
)
_DECODED_OUT = """block_number, logs_address, from_address, to_address, CAST(raw AS VARCHAR) AS value,
  logs_transaction_index, logs_transaction_hash, CAST(date_time AS VARCHAR) AS date_time,
  CAST(transaction_date AS VARCHAR) AS transaction_date"""
register("transfer_decode", _decoded, f"WITH {B}, {_SELECT_SQL} SELECT {_DECODED_OUT} FROM sel")
register("transfer_valid", _valid, f"WITH {B}, {_VALID_SQL} SELECT {_DECODED_OUT} FROM val")
register(
    "transfer_enrich",
    _enriched,
    f"""WITH {B}, {_VALID_SQL}, {V.TOKEN_PRICES_SQL},
    v1 AS (SELECT val.*, id, decimals, token_symbol FROM val JOIN tok ON logs_address = address),
    v2 AS (SELECT v1.*, price_us, CAST(price_us * 100 AS BIGINT) AS pcent
           FROM v1 LEFT JOIN pr ON v1.id = pr.id AND v1.transaction_date = pr.transaction_date),
    v3 AS (SELECT * FROM {amount_sql('v2', 'raw', 'pcent', 'decimals')})
    SELECT block_number, from_address, to_address,
      CASE WHEN raw IS NOT NULL THEN {scaled_sql('raw', 'decimals')} END AS value,
      rtrim(rtrim(CAST(price_us AS VARCHAR), '0'), '.') AS price_us, amount, logs_transaction_index,
      logs_transaction_hash, id AS token_id, token_symbol, logs_address AS token_address, {TIMES} FROM v3""",
)
register(
    "price_by_symbol",
    lambda spark, sf: transfers.price_by_symbol(
        V.token_dim(spark, sf).select("token_symbol").distinct(), V.token_dim(spark, sf), V.token_prices(spark, sf)
    ),
    f"""WITH {V.TOKENS_SQL}, {V.TOKEN_PRICES_SQL}
    SELECT id, token_symbol, rtrim(rtrim(CAST(price_us AS VARCHAR), '0'), '.') AS price_us,
      CAST(transaction_date AS VARCHAR) AS transaction_date FROM tok JOIN pr USING (id)""",
)

# --------------------------------------------------------------- native ledger

_REWARD = "CASE WHEN b > 7080000 THEN 2 WHEN b >= 4370000 THEN 3 ELSE 5 END"
_FEES_SQL = f"""fee AS (
  SELECT b, sum(CASE WHEN ({V.RECEIPT_MISSING}) OR k % 13 = 12 THEN 0
                ELSE CAST(({V.GAS_USED}) AS HUGEINT) * (1000000000 * (k % 50 + 1)) END) AS wei
  FROM tx GROUP BY b)"""
_LEDGER_COLUMNS = "from_address, to_address, u, transaction_index, transaction_hash, transaction_type"
_LEDGER_SQL = f"""{_FEES_SQL}, {_CALLS_SQL},
lu AS (SELECT b, '0x^0' AS from_address, {_clean(V.UNCLE_DOC['miner'])} AS to_address,
        CAST((b - 1 - i + 8 - b) * {_REWARD} AS HUGEINT) * 125000000000000000 AS u,
        '' AS transaction_index, '' AS transaction_hash, 'uncles' AS transaction_type, dh, date_time, transaction_date
      FROM (SELECT * FROM jt, unnest(range(k % 3)) AS w(i)) WHERE i <> 1),
lb AS (SELECT jt.b, '0x^0' AS from_address, {_clean(V.BLOCK_DOC['miner'])} AS to_address,
        CAST({_REWARD.replace('b ', 'jt.b ')} AS HUGEINT)
          * ({E18} + least(k % 3, 1) * 31250000000000000) + coalesce(wei, 0) AS u,
        '' AS transaction_index, '' AS transaction_hash, 'reward_charge' AS transaction_type,
        dh, date_time, transaction_date
      FROM jt LEFT JOIN fee ON jt.b = fee.b),
lt AS (SELECT b, lower({V.TRACE_DOC['from']}) AS from_address, lower({V.TRACE_DOC['to']}) AS to_address,
        CAST({V.RAW_VALUE} + j AS HUGEINT) AS u, CAST(j AS VARCHAR) AS transaction_index,
        lower({V.TX_HASH}) AS transaction_hash, 'trace' AS transaction_type, dh, date_time, transaction_date
      FROM tx WHERE NOT ({V.TRACE_MISSING}) AND (k + j) % 7 <> 0 AND k % 19 <> 18),
lc AS (SELECT block_number AS b, calls_from AS from_address, calls_to AS to_address,
        CAST({V.RAW_VALUE} + n AS HUGEINT) AS u, calls_transaction_index AS transaction_index,
        calls_transaction_hash AS transaction_hash, 'calls' AS transaction_type, dh, date_time, transaction_date
      FROM cl WHERE calls_error = '' AND calls_to <> ''),
mv AS (SELECT * FROM lt UNION ALL SELECT * FROM lc),
al AS (SELECT * FROM lu UNION ALL SELECT * FROM lb UNION ALL SELECT * FROM mv)"""
_PLAIN_TIMES = "CAST(date_time AS VARCHAR) AS date_time, CAST(transaction_date AS VARCHAR) AS transaction_date"
_LEDGER_OUT = f"""SELECT b AS block_number, from_address, to_address, {scaled_sql('u', '18')} AS value,
  transaction_index, transaction_hash, transaction_type, {_PLAIN_TIMES}"""


def _fees(spark: SparkSession, sf: str) -> DataFrame:
    return native.block_fees(V.part_table(spark, sf, "base"))


def _block_rewards(spark: SparkSession, sf: str) -> DataFrame:
    return native.block_rewards(V.part_table(spark, sf, "block"), V.part_table(spark, sf, "uncles"), _fees(spark, sf))


def _movements(spark: SparkSession, sf: str) -> DataFrame:
    return native.trace_movements(V.part_table(spark, sf, "trace")).unionByName(
        native.call_movements(V.part_table(spark, sf, "calls"))
    )


def _ledger(spark: SparkSession, sf: str) -> DataFrame:
    return native.native_ledger(
        V.part_table(spark, sf, "block"),
        V.part_table(spark, sf, "base"),
        V.part_table(spark, sf, "uncles"),
        V.part_table(spark, sf, "trace"),
        V.part_table(spark, sf, "calls"),
    )


register(
    "block_fees",
    _fees,
    f"WITH {B}, {_FEES_SQL} SELECT b AS block_number, {scaled_sql('wei', '18')} AS service_charge FROM fee",
)
register(
    "uncle_rewards",
    lambda spark, sf: native.uncle_rewards(V.part_table(spark, sf, "uncles")),
    f"WITH {B}, {_LEDGER_SQL} {_LEDGER_OUT} FROM lu",
)
register(
    "reward_schedule",
    lambda spark, sf: V.load(spark, sf, "orders")
    .select((F.col("o_orderkey") * 200 + 4_365_000).alias("block_number"))
    .select("block_number", native.step_lookup(F.col("block_number"), native.REWARD_STEPS).alias("reward")),
    f"SELECT b AS block_number, {_REWARD} AS reward FROM (SELECT o_orderkey * 200 + 4365000 AS b FROM orders)",
)
register("block_rewards", _block_rewards, f"WITH {B}, {_LEDGER_SQL} {_LEDGER_OUT} FROM lb")
register("movements", _movements, f"WITH {B}, {_LEDGER_SQL} {_LEDGER_OUT} FROM mv")
register("native_ledger", _ledger, f"WITH {B}, {_LEDGER_SQL} {_LEDGER_OUT} FROM al")
register(
    "ledger_priced",
    lambda spark, sf: native.price_ledger(_ledger(spark, sf), V.native_prices(spark, sf)),
    f"""WITH {B}, {_LEDGER_SQL}, {V.NATIVE_PRICES_SQL},
    p1 AS (SELECT al.*, coalesce(price_us, 0) AS price_us, CAST(coalesce(price_us, 0) * 100 AS BIGINT) AS pcent
           FROM al LEFT JOIN np ON al.transaction_date = np.transaction_date),
    p2 AS (SELECT * FROM {amount_sql('p1')})
    SELECT b AS block_number, from_address, to_address, {scaled_sql('u', '18')} AS value,
      rtrim(rtrim(CAST(price_us AS VARCHAR), '0'), '.') AS price_us, amount, transaction_index, transaction_hash,
      dh, {_PLAIN_TIMES}, transaction_type FROM p2""",
)
