"""One query per column expression."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from ledgerlake.functions import dates, numbers, text
from ledgerlake.plans import views as V
from ledgerlake.plans.ledger_queries import amount_sql, scaled_sql
from ledgerlake.plans.registry import register

PC = "CAST(round(o_totalprice * 100) AS BIGINT)"


def _orders(*columns: str):
    return lambda spark, sf: V.load(spark, sf, "orders").selectExpr("o_orderkey", *columns)


def _json_field(spark: SparkSession, sf: str) -> DataFrame:
    events = V.load(spark, sf, "events")
    item = F.when(F.col("event_id") % 3 > 0, F.get_json_object("props", "$.k")).otherwise("")
    wrapped = F.concat(F.lit('{"list":['), item, F.lit("]}"))
    return events.select(
        "event_id",
        text.json_field(F.col("props"), "$.k").alias("k"),
        text.json_field(F.col("props"), "$.missing").alias("missing"),
        text.json_array(wrapped, "$.list", LongType())[0].cast("string").alias("first_item"),
    )


register(
    "json_field",
    _json_field,
    """SELECT event_id, json_extract_string(props, '$.k') AS k, '' AS missing,
      CASE WHEN event_id % 3 > 0 THEN json_extract_string(props, '$.k') END AS first_item FROM events""",
)


def _string_normalise(spark: SparkSession, sf: str) -> DataFrame:
    parts = V.load(spark, sf, "part")
    listed = text.split_json_list(F.to_json(F.array("p_brand", "p_type", "p_name")))
    return parts.select(
        "p_partkey",
        text.clean_lower(F.concat(F.lit(" \t"), "p_brand", F.lit("\n "))).alias("brand"),
        listed[1].alias("second"),
        F.size(listed).alias("items"),
        text.clean(F.lit(None).cast(StringType())).alias("blank"),
    )


register(
    "string_normalise",
    _string_normalise,
    "SELECT p_partkey, lower(p_brand) AS brand, p_type AS second, 3 AS items, '' AS blank FROM part",
)


def _hex(spark: SparkSession, sf: str) -> DataFrame:
    seeds = _orders(f"{PC} as pc")(spark, sf)
    word = lambda sql: numbers.hex_to_decimal(F.expr(sql))
    return seeds.select(
        "o_orderkey",
        word("concat('0x', lower(hex(pc)))").alias("short"),
        word("concat(hex(pc), lpad(hex(o_orderkey), 15, '0'))").alias("middle"),
        word("concat('0x', hex(pc), lpad(hex(o_orderkey), 25, '0'))").alias("wide"),
        word("lpad(hex(pc), 64, '0')").alias("padded"),
        word("case when o_orderkey % 2 = 0 then '0x' else 'no hex' end").alias("bad"),
    )


register(
    "hex_to_decimal",
    _hex,
    f"""SELECT o_orderkey, CAST(pc AS VARCHAR) AS short,
      CAST(CAST(pc AS HUGEINT) * 1152921504606846976 + o_orderkey AS VARCHAR) AS middle,
      CAST(CAST(pc AS HUGEINT) * CAST(1267650600228229401496703205376 AS HUGEINT) + o_orderkey AS VARCHAR) AS wide,
      CAST(pc AS VARCHAR) AS padded, CAST(NULL AS VARCHAR) AS bad
    FROM (SELECT o_orderkey, {PC} AS pc FROM orders)""",
)


def _unit_scale(spark: SparkSession, sf: str) -> DataFrame:
    seeds = _orders(f"{PC} as pc", "cast(o_orderkey % 19 as int) as places")(spark, sf)
    digits = F.col("pc").cast("string")
    return seeds.select(
        "o_orderkey",
        numbers.unit_scale_text(digits, F.col("places")).alias("as_text"),
        numbers.shift_point(F.concat(digits, F.lit(".05")), F.col("places")).alias("shifted"),
        numbers.wei_to_units(F.concat(F.lit("0x"), F.hex("pc"))).alias("wei"),
    )


_SCALED = scaled_sql("pc", "places")
register(
    "unit_scale",
    _unit_scale,
    f"""SELECT o_orderkey, {_SCALED} AS as_text, {scaled_sql('pc * 100 + 5', '(places + 2)')} AS shifted, {scaled_sql('pc', '18')} AS wei
    FROM (SELECT o_orderkey, {PC} AS pc, o_orderkey % 19 AS places FROM orders)""",
)
_UNITS = f"CAST({PC} AS HUGEINT) * 1000000007 * (o_orderkey + 1)"


def _exact_amount(spark: SparkSession, sf: str) -> DataFrame:
    seeds = _orders(f"cast({PC} as decimal(20,0)) * 1000000007 * (o_orderkey + 1) as u", "o_totalprice")(spark, sf)
    value = numbers.unit_scale_text(F.col("u").cast("string"), F.lit(18))
    return seeds.select(
        "o_orderkey", numbers.exact_amount(value, F.col("o_totalprice").cast("decimal(18,2)")).alias("amount")
    )


register(
    "exact_amount",
    _exact_amount,
    f"""WITH s AS (SELECT o_orderkey, {_UNITS} AS u, {PC} AS pcent FROM orders)
    SELECT o_orderkey, amount FROM {amount_sql('s')}""",
)
register(
    "plain_decimal",
    lambda spark, sf: V.load(spark, sf, "part").select(
        "p_partkey",
        numbers.plain_decimal(F.col("p_retailprice")).alias("price"),
        numbers.plain_decimal(F.col("p_partkey").cast("decimal(38,18)") / 1_000_000_000).alias("small"),
        numbers.plain_decimal(F.col("p_partkey") * 1e12).alias("large"),
    ),
    f"""SELECT p_partkey, rtrim(rtrim(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR), '0'), '.') AS price,
      {scaled_sql('p_partkey', '9')} AS small, CAST(p_partkey * 1000000000000 AS VARCHAR) AS large FROM part""",
)
_EPOCH = "datediff(to_date(o_orderdate), date'1970-01-01') * 86400L + (o_orderkey * 37) % 86400"


def _with_time(spark: SparkSession, sf: str) -> DataFrame:
    seeds = _orders(f"case when o_orderkey % 7 = 6 then 'n/a' else cast({_EPOCH} as string) end as seconds")(spark, sf)
    return seeds.select("o_orderkey", dates.epoch_to_ts(F.col("seconds")).alias("ts"))


_TIME_SQL = """tm AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 6 THEN
  o_orderdate + to_seconds((o_orderkey * 37) % 86400) END AS ts FROM orders)"""
register("epoch_to_ts", _with_time, f"WITH {_TIME_SQL} SELECT o_orderkey, CAST(ts AS VARCHAR) AS ts FROM tm")
register(
    "date_parts",
    lambda spark, sf: _with_time(spark, sf).select(
        "o_orderkey", *[part.alias(name) for name, part in dates.date_parts(F.col("ts")).items()]
    ),
    f"""WITH {_TIME_SQL} SELECT o_orderkey, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
      strftime(ts, '%d') AS day, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, strftime(ts, '%H') AS hour FROM tm""",
)


def _dated(*columns):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        orders = V.load(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
        return orders.select("o_orderkey", *[make(F.col("d")).alias(name) for name, make in columns])

    return run


def _dated_sql(**columns: str) -> str:
    listed = ", ".join(f"CAST(CAST({sql} AS DATE) AS VARCHAR) AS {name}" for name, sql in columns.items())
    return f"SELECT o_orderkey, {listed} FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)"


register(
    "date_shift",
    _dated(
        *[(f"minus_{n}", lambda d, n=n: dates.shift_days(d, -n)) for n in (1, 7, 30, 60)],
        ("plus_1", lambda d: dates.shift_days(d, 1)),
    ),
    _dated_sql(**{f"minus_{n}": f"d - {n}" for n in (1, 7, 30, 60)}, plus_1="d + 1"),
)
register("week_monday", _dated(("monday", dates.week_monday)), _dated_sql(monday="date_trunc('week', d)"))
register(
    "week_bounds",
    _dated(("monday", lambda d: dates.period(d, "week")), ("sunday", dates.week_sunday)),
    _dated_sql(monday="d - CAST(isodow(d) - 1 AS INT)", sunday="d + CAST(7 - isodow(d) AS INT)"),
)
register(
    "month_bounds",
    _dated(("first", dates.month_first), ("last", dates.month_last)),
    _dated_sql(first="date_trunc('month', d)", last="last_day(d)"),
)


def _null_fill(spark: SparkSession, sf: str) -> DataFrame:
    filled = V.transfers(spark, sf).withColumn("filled", F.coalesce("amount", F.lit(0).cast("decimal(18,2)")))
    return filled.groupBy("token_address").agg(
        F.sum(F.when(F.col("amount").isNull(), 0).otherwise(1)).alias("priced"),
        F.sum(F.when(F.col("value") > 25, F.when(F.col("value") > 40, 2).otherwise(1)).otherwise(0)).alias("graded"),
        numbers.sum_exact(filled, "filled").alias("amount"),
    )


register(
    "null_fill",
    _null_fill,
    f"""WITH {V.TRANSFERS_SQL} SELECT token_address, count(amount) AS priced,
      CAST(sum(CASE WHEN value > 40 THEN 2 WHEN value > 25 THEN 1 ELSE 0 END) AS BIGINT) AS graded,
      CAST(sum(amount) AS DOUBLE) AS amount FROM t GROUP BY ALL""",
)


def _predicates(spark: SparkSession, sf: str) -> DataFrame:
    lines = V.load(spark, sf, "lineitem")
    rich = V.exchanges(spark, sf).select(F.col("address").cast("bigint").alias("l_suppkey"))
    latest = lines.agg(F.max("l_shipdate").alias("m")).scalar()
    return (
        lines.where(F.col("l_quantity").between(10, 40))
        .where((F.col("l_returnflag") != "R") & (F.col("l_tax") <= 0.06) & (F.col("l_discount") >= 0.02))
        .where(F.col("l_linenumber").isin(1, 2, 3) & F.col("l_linestatus").rlike("^[FO]$"))
        .where(F.col("l_shipdate").isNotNull() & (F.col("l_shipdate") < latest))
        .join(rich, "l_suppkey", "left_semi")
        .groupBy("l_suppkey", "l_linenumber")
        .agg(F.count("*").alias("n"))
    )


register(
    "predicate_mix",
    _predicates,
    f"""WITH {V.EXCHANGES_SQL} SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem
    WHERE l_quantity BETWEEN 10 AND 40 AND l_returnflag <> 'R' AND l_tax <= 0.06 AND l_discount >= 0.02
      AND l_linenumber IN (1, 2, 3) AND regexp_matches(l_linestatus, '^[FO]$') AND l_shipdate IS NOT NULL
      AND l_shipdate < (SELECT max(l_shipdate) FROM lineitem)
      AND CAST(l_suppkey AS VARCHAR) IN (SELECT address FROM x) GROUP BY ALL""",
)
