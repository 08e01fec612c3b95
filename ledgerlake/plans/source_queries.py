"""Source, sink and load-control queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators import metrics, parse
from ledgerlake.plans import views as V
from ledgerlake.plans.registry import register
from ledgerlake.session import scratch_path
from ledgerlake.sources import dims, readers, sinks, windows

DAY, T = V.DAY, V.TRANSFERS_SQL

# ---------------------------------------------------------------------- scans

LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"]
_LINE_SQL = ", ".join(LINE[:-1]) + ", CAST(l_shipdate AS VARCHAR) AS l_shipdate"


def _scan(**when: str):
    return lambda spark, sf: readers.scan(V.load(spark, sf, "lineitem"), column="l_shipdate", **when).select(*LINE)


register("scan_day", _scan(on=DAY), f"SELECT {_LINE_SQL} FROM lineitem WHERE CAST(l_shipdate AS DATE) = '{DAY}'")
register(
    "scan_since", _scan(since="2001-06-01"), f"SELECT {_LINE_SQL} FROM lineitem WHERE l_shipdate >= '2001-06-01'"
)
register(
    "scan_month",
    _scan(month="2001-06"),
    f"SELECT {_LINE_SQL} FROM lineitem WHERE strftime(l_shipdate, '%Y-%m') = '2001-06'",
)

# Documents arrive in a monthly folder, some of them one or two days late.
ARRIVAL = "date_add(last_day(d), cast(k % 3 as int))"
FOLDERS = {"local_date": ARRIVAL, "node": "k % 2", "kind": "concat('logs-', k % 2)"}
FILE_ROWS = 50_000  # of a compressed file, which one task reads whole
RAW_DAY, RAW_SINCE = "2001-07-02", "2001-06-10"


def _raw_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "raw")
    documents = V.block_documents(spark, sf, *FOLDERS, by=FOLDERS)
    documents.write.partitionBy(*FOLDERS).option("maxRecordsPerFile", FILE_ROWS).text(root, compression="gzip")
    lines = readers.read_raw(spark, root, RAW_DAY, windows.Windows().raw, "*")
    return readers.scan(parse.envelope(lines), since=RAW_SINCE).drop("info")


register(
    "raw_json_lines",
    _raw_json_lines,
    f"""WITH {V.BLOCKS_SQL} SELECT b AS block_number, dh, CAST(date_time AS VARCHAR) AS date_time,
      CAST(transaction_date AS VARCHAR) AS transaction_date
    FROM jt JOIN orders ON k = o_orderkey
    WHERE last_day(CAST(o_orderdate AS DATE)) + CAST(k % 3 AS INT) BETWEEN DATE '{RAW_DAY}' - 2 AND DATE '{RAW_DAY}'
      AND transaction_date >= DATE '{RAW_SINCE}'""",
)

def _import_by_dir(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of import folders, kept by folder and date; one folder is imported anew with half of its documents."""
    path = scratch_path(spark, "import")
    documents = V.block_documents(spark, sf, "concat('node-', k % 3) as dir", "k")
    rows = parse.envelope(documents, keep=("dir", "k"))
    sinks.write_partitions(rows, path, parse.IMPORT_KEYS)
    sinks.write_partitions(rows.where("dir = 'node-1' AND k % 2 = 0").withColumn("k", -F.col("k")), path, parse.IMPORT_KEYS)
    # A date as a folder name is read as a date again; documents without one stand in the default folder.
    return spark.read.parquet(path).select("block_number", "k", "dh", "date_time", "dir", "transaction_date")


register(
    "import_by_dir",
    _import_by_dir,
    f"""WITH {V.BLOCKS_SQL}, r AS (SELECT *, k % 3 AS m FROM jt),
    again AS (SELECT DISTINCT transaction_date AS d FROM r WHERE m = 1 AND k % 2 = 0),
    kept AS (SELECT b, k, dh, date_time, m, transaction_date FROM r
             WHERE m <> 1 OR NOT EXISTS (SELECT 1 FROM again WHERE d IS NOT DISTINCT FROM transaction_date)
             UNION ALL SELECT b, -k, dh, date_time, m, transaction_date FROM r WHERE m = 1 AND k % 2 = 0)
    SELECT b AS block_number, k, dh, CAST(date_time AS VARCHAR) AS date_time, concat('node-', m) AS dir,
      CAST(transaction_date AS VARCHAR) AS transaction_date FROM kept""",
)

# ----------------------------------------------------------------- dimensions

CSV_SCHEMA = "id string, address string, decimals int, symbol string, total_supply string, date_time string"


def _raw_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return V.load(spark, sf, "part").selectExpr(
        "case when p_partkey % 10 > 0 then concat('tok-', p_partkey) end as id",
        f"{V.addr('p_partkey')} as address",
        "cast(p_partkey % 19 as int) as decimals",
        "p_brand as symbol",
        "p_retailprice * 1000 as total_supply",
        "'2024-01-01 00:00:00' as date_time",
    )


_TOKEN_DIM_SQL = f"""SELECT CASE WHEN p_partkey % 10 > 0 THEN concat('tok-', p_partkey) ELSE '' END AS id,
  lower({V.addr('p_partkey')}) AS address, CAST(p_partkey % 19 AS INT) AS decimals, p_brand AS token_symbol,
  CAST(CAST(round(p_retailprice * 1000) AS BIGINT) AS VARCHAR) AS total_suply, '2024-01-01 00:00:00' AS date_time
  FROM part"""


def _csv_token_dim(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "token-csv")
    _raw_tokens(spark, sf).write.csv(path)
    return dims.normalise_token_dim(readers.read_csv_dim(spark, path, CSV_SCHEMA))


def _quotes(spark: SparkSession, sf: str) -> DataFrame:
    return V.load(spark, sf, "orders").selectExpr(
        "concat('tok-', o_custkey) as id",
        "o_orderpriority as symbol",
        "case when o_orderkey % 4 = 0 then 0 else o_totalprice end as price_us",
        "to_date(o_orderdate) as time",
    )


register("csv_token_dim", _csv_token_dim, _TOKEN_DIM_SQL)
register("token_dim", lambda spark, sf: dims.normalise_token_dim(_raw_tokens(spark, sf)), _TOKEN_DIM_SQL)
register(
    "price_dim",
    lambda spark, sf: dims.load_price_dim(_quotes(spark, sf), DAY),
    f"""SELECT concat('tok-', o_custkey) AS id, o_orderpriority AS token_symbol, o_totalprice AS price_us,
      '{DAY}' AS transaction_date FROM orders WHERE o_orderkey % 4 <> 0 AND CAST(o_orderdate AS DATE) = '{DAY}'""",
)

# ---------------------------------------------------------------------- sinks


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    daily = metrics.rollup_metric(V.transfers(spark, sf), V.transfer_spine(spark, sf), "trades")
    return daily.withColumn("year", F.year("transaction_date")).withColumn("month", F.month("transaction_date"))


_DAILY_SQL = f"""WITH {T}, {V.SPINE_SQL},
  a AS (SELECT token_address, transaction_date, count(*) AS v FROM t GROUP BY ALL),
  dl AS (SELECT coalesce(v, 0) AS value_num, token_address, transaction_date, year(transaction_date) AS year,
                month(transaction_date) AS month
         FROM spine LEFT JOIN a USING (token_address, transaction_date))"""


def _write_dynamic_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Stale values everywhere, then a rewrite from 1998 on: earlier years keep what they had."""
    path = scratch_path(spark, "dynamic")
    daily = _daily(spark, sf)
    sinks.write_partitions(daily.withColumn("value_num", F.lit(-1).cast("bigint")), path, ["year"])
    sinks.write_partitions(readers.scan(daily, since="1998-01-01"), path, ["year"])
    return spark.read.parquet(path).select("value_num", "token_address", "transaction_date", F.col("year").cast("bigint"))


register(
    "write_dynamic_overwrite",
    _write_dynamic_overwrite,
    f"""{_DAILY_SQL} SELECT CASE WHEN year >= 1998 THEN value_num ELSE -1 END AS value_num, token_address,
      CAST(transaction_date AS VARCHAR) AS transaction_date, year FROM dl""",
)


def _write_twice(mode: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        path = scratch_path(spark, mode)
        parts = V.load(spark, sf, "part").select("p_partkey", "p_brand")
        sinks.write_table(parts, path)
        sinks.write_table(V.load(spark, sf, "supplier").selectExpr("s_suppkey as p_partkey", "s_name as p_brand"), path, mode)
        return spark.read.parquet(path)

    return run


_SUPPLIER_SQL = "SELECT s_suppkey AS p_partkey, s_name AS p_brand FROM supplier"
register("write_append", _write_twice("append"), f"SELECT p_partkey, p_brand FROM part UNION ALL {_SUPPLIER_SQL}")
register("write_overwrite", _write_twice("overwrite"), _SUPPLIER_SQL)


def _partition_listing(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "listing")
    sinks.write_partitions(_daily(spark, sf), path, ["year", "month"])
    return sinks.partition_listing(spark.read.parquet(path), ["year", "month"]).select(
        F.col("year").cast("bigint"), F.col("month").cast("bigint")
    )


register("partition_listing", _partition_listing, f"{_DAILY_SQL} SELECT DISTINCT year, month FROM dl")

# --------------------------------------------------------------- load control

ODS = ["to_address", "token_address", "value", "transaction_date"]
LEDGER = ["from_address", *ODS[:-1], "amount", "transaction_date"]


def _promoted_sql(columns: list[str], lookback: int) -> str:
    plain = {c: f"rtrim(rtrim(CAST({c} AS VARCHAR), '0'), '.') AS {c}" for c in ("value", "amount")}
    plain["transaction_date"] = "CAST(transaction_date AS VARCHAR) AS transaction_date"
    listed = ", ".join(plain.get(c, c) for c in columns)
    return f"WITH {T} SELECT {listed} FROM t WHERE t.transaction_date >= DATE '{DAY}' - {lookback}"


register(
    "promote_window",
    lambda spark, sf: windows.promote(V.transfers(spark, sf), ODS, DAY, windows.Windows().ods),
    _promoted_sql(ODS, 2),
)
register(
    "promote_ledger",
    lambda spark, sf: windows.promote(V.transfers(spark, sf), LEDGER, DAY, windows.Windows().ledger),
    _promoted_sql(LEDGER, 3),
)


def _late_data(spark: SparkSession, sf: str) -> DataFrame:
    """A table written before the returned lines had arrived, then its last days recomputed with them and replaced."""
    lines, parts = V.load(spark, sf, "lineitem"), V.load(spark, sf, "part")
    dated = lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        F.col("p_brand").alias("token_address"), F.to_date("l_shipdate").alias("transaction_date"), "l_returnflag"
    )
    by_month = F.date_format("transaction_date", "yyyy-MM")
    trades = lambda rows: (
        rows.groupBy("token_address", "transaction_date").agg(F.count("*").alias("value_num")).withColumn("month", by_month)
    )
    path = scratch_path(spark, "late")
    sinks.write_partitions(trades(dated.where(F.col("l_returnflag") != "R")), path, ["month", "transaction_date"])
    since = windows.Windows().since("ledger", DAY)
    sinks.write_partitions(trades(readers.scan(dated, since=since)), path, ["month", "transaction_date"])
    return spark.read.parquet(path).select("token_address", "transaction_date", "value_num")


register(
    "late_data_reprocess",
    _late_data,
    f"""WITH d AS (SELECT p_brand AS token_address, CAST(l_shipdate AS DATE) AS transaction_date, l_returnflag
                   FROM lineitem JOIN part ON l_partkey = p_partkey)
    SELECT token_address, CAST(transaction_date AS VARCHAR) AS transaction_date, count(*) AS value_num FROM d
    WHERE transaction_date >= DATE '{DAY}' - 3 OR l_returnflag <> 'R' GROUP BY ALL""",
)
