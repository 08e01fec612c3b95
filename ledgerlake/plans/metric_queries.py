"""First-seen, spine and metric queries over the transfer and event views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators import activity, entities, flows, metrics, rankings, spine, totals
from ledgerlake.plans import views as V
from ledgerlake.plans.registry import register

DAY, EVENT_DAY = V.DAY, V.EVENT_DAY
T, SP, E, ES = V.TRANSFERS_SQL, V.SPINE_SQL, V.EVENTS_SQL, V.EVENT_SPINE_SQL

# ------------------------------------------------------------- participants


def _participants(spark: SparkSession, sf: str) -> DataFrame:
    return entities.participants(V.transfers(spark, sf))


register(
    "participants",
    _participants,
    f"""WITH {T} SELECT from_address AS customer_address, token_address, CAST(date_time AS VARCHAR) AS date_time,
      CAST(transaction_date AS VARCHAR) AS transaction_date FROM t
    UNION ALL SELECT to_address, token_address, CAST(date_time AS VARCHAR), CAST(transaction_date AS VARCHAR) FROM t""",
)

# ---------------------------------------------------------------- first seen


def _first_seen(keys: list[str], sides: tuple[str, ...], day: str | None):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ledger = V.transfers(spark, sf)
        if day is None:
            return entities.first_seen(ledger, keys, sides)
        return entities.first_seen(ledger, keys, sides, day, V.first_seen_table(spark, sf, tuple(keys), sides))

    return run


def _first_seen_sql(keys: list[str], sides: tuple[str, ...]) -> str:
    listed = "".join(f", {k}" for k in keys)
    rows = " UNION ALL ".join(f"SELECT {s} AS customer_address{listed}, date_time FROM t" for s in sides)
    return f"""fs AS (
  SELECT customer_address{listed}, strftime(min(date_time), '%H') AS dh, min(date_time) AS date_time,
         CAST(min(date_time) AS DATE) AS transaction_date
  FROM ({rows}) GROUP BY customer_address{listed})"""


def _first_seen_oracle(keys: list[str], sides: tuple[str, ...], day: str | None) -> str:
    listed = "".join(f", {k}" for k in keys)
    where = "" if day is None else f" WHERE transaction_date = DATE '{day}'"
    return f"""WITH {T}, {_first_seen_sql(keys, sides)}
    SELECT customer_address{listed}, dh, CAST(date_time AS VARCHAR) AS date_time,
           CAST(transaction_date AS VARCHAR) AS transaction_date FROM fs{where}"""


# The address universe of the view is closed early, so the daily runs use an early day.
FIRST_DAY = {"first_seen_address": "1995-01-20", "first_seen_token": "1995-06-30", "first_seen_sender": DAY}
for _name, _keys, _sides in (
    ("first_seen_address", [], entities.BOTH_SIDES),
    ("first_seen_token", ["token_address"], entities.BOTH_SIDES),
    ("first_seen_sender", ["token_address"], ("from_address",)),
):
    for _mode, _day in (("full", None), ("day", FIRST_DAY[_name])):
        register(f"{_name}_{_mode}", _first_seen(_keys, _sides, _day), _first_seen_oracle(_keys, _sides, _day))

# ---------------------------------------------------------------------- spine

register(
    "spine_days",
    V.transfer_spine,
    f"WITH {SP} SELECT token_address, CAST(transaction_date AS VARCHAR) AS transaction_date FROM spine",
)
register(
    "spine_hours",
    lambda spark, sf: spine.spine_hours(V.event_spine(spark, sf)),
    f"""WITH {ES} SELECT token_address, CAST(transaction_date AS VARCHAR) AS transaction_date,
      lpad(CAST(h AS VARCHAR), 2, '0') AS dh FROM es, unnest(range(24)) AS u(h)""",
)

# ------------------------------------------------------------------- roll-ups

TOKEN_KEYS = ["token_address"]
NEW_SQL = _first_seen_sql(TOKEN_KEYS, entities.BOTH_SIDES)
AGGREGATE_SQL = {
    "volume": "CAST(coalesce(sum(value), 0) AS DOUBLE)",
    "amount": "CAST(coalesce(sum(amount), 0) AS DOUBLE)",
    "trades": "count(*)",
    "new_addresses": "count(*)",
}


def _ledger(spark: SparkSession, sf: str, measure: str, day: str | None) -> DataFrame:
    """A daily run reads the kept first-seen table, a backfill makes it from the ledger."""
    if measure != "new_addresses":
        return V.transfers(spark, sf)
    return entities.first_seen(V.transfers(spark, sf)) if day is None else V.first_seen_table(spark, sf, ("token_address",))


def _rollup(measure: str, grain: str, day: str | None):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return metrics.rollup_metric(_ledger(spark, sf, measure, day), V.transfer_spine(spark, sf), measure, grain, day)

    return run


def _rollup_oracle(measure: str, grain: str, day: str | None) -> str:
    source, table = (f"{T}, {NEW_SQL}", "fs") if measure == "new_addresses" else (T, "t")
    key = "transaction_date" if grain == "day" else f"CAST(date_trunc('{grain}', transaction_date) AS DATE)"
    facts = listed = "true"
    if day is not None:
        start = {
            "day": f"DATE '{day}'",
            "week": f"CAST(date_trunc('week', DATE '{day}') AS DATE)",
            "month": f"CAST(date_trunc('month', DATE '{day}') AS DATE)",
        }[grain]
        stop = f"last_day(DATE '{day}')" if grain == "month" else f"DATE '{day}'"
        facts = f"transaction_date BETWEEN {start} AND {stop}"
        listed = facts if grain == "month" else f"transaction_date = DATE '{day}'"
    return f"""WITH {source}, {SP},
    s AS (SELECT DISTINCT token_address, {key} AS p FROM spine WHERE {listed}),
    a AS (SELECT token_address, {key} AS p, {AGGREGATE_SQL[measure]} AS v FROM {table} WHERE {facts} GROUP BY ALL)
    SELECT coalesce(v, 0) AS value_num, token_address, CAST(p AS VARCHAR) AS transaction_date
    FROM s LEFT JOIN a USING (token_address, p)"""


# Nearly all addresses are old by DAY; new ones are counted on an earlier day.
MEASURE_DAY = {"new_addresses": "1995-06-30"}
for _measure in metrics.MEASURES:
    for _grain in ("day", "week", "month"):
        for _mode, _day in (("day", MEASURE_DAY.get(_measure, DAY)), ("full", None)):
            register(
                f"{_measure}_{_grain}_{_mode}",
                _rollup(_measure, _grain, _day),
                _rollup_oracle(_measure, _grain, _day),
            )


def _grains(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.rollup_grains(V.transfers(spark, sf), V.transfer_spine(spark, sf), "volume")


def _grains_oracle() -> str:
    steps, parts = [], []
    for grain in ("day", "week", "month"):
        key = f"CAST(date_trunc('{grain}', transaction_date) AS DATE) AS p"
        steps.append(f"s_{grain} AS (SELECT DISTINCT token_address, {key} FROM spine)")
        steps.append(f"a_{grain} AS (SELECT token_address, {key}, CAST(sum(value) AS DOUBLE) AS v FROM t GROUP BY ALL)")
        parts.append(
            f"""SELECT coalesce(v, 0) AS value_num, token_address, CAST(p AS VARCHAR) AS transaction_date,
            '{grain}' AS grain FROM s_{grain} LEFT JOIN a_{grain} USING (token_address, p)"""
        )
    return f"WITH {T}, {SP}, {', '.join(steps)} {' UNION ALL '.join(parts)}"


register("volume_all_grains", _grains, _grains_oracle())

# A range of days at once, over the turn of a month: the incremental runs of each of its days.
RANGE = ("2001-06-20", "2001-07-10")


def _range_oracle(measure: str, grain: str) -> str:
    stop = "last_day(run_date)" if grain == "month" else "run_date"
    listed = f"s.transaction_date BETWEEN p AND {stop}" if grain == "month" else "s.transaction_date = run_date"
    return f"""WITH {T}, {SP},
    r AS (SELECT run_date, CAST(date_trunc('{grain}', run_date) AS DATE) AS p
          FROM (SELECT CAST(unnest(generate_series(DATE '{RANGE[0]}', DATE '{RANGE[1]}', INTERVAL 1 DAY)) AS DATE) AS run_date)),
    l AS (SELECT DISTINCT token_address, p, run_date FROM r JOIN spine s ON {listed}),
    a AS (SELECT token_address, run_date, {AGGREGATE_SQL[measure]} AS v FROM r JOIN t ON t.transaction_date BETWEEN p AND {stop} GROUP BY ALL)
    SELECT coalesce(v, 0) AS value_num, token_address, CAST(p AS VARCHAR) AS transaction_date, CAST(run_date AS VARCHAR) AS run_date
    FROM l LEFT JOIN a USING (token_address, run_date)"""


for _measure, _grain in (("volume", "day"), ("volume", "week"), ("trades", "week"), ("amount", "month")):
    register(
        f"{_measure}_{_grain}_range",
        lambda spark, sf, measure=_measure, grain=_grain: metrics.rollup_range(
            V.transfers(spark, sf), V.transfer_spine(spark, sf), measure, grain, *RANGE
        ),
        _range_oracle(_measure, _grain),
    )

# ---------------------------------------------------------------------- hours


def _hourly(measure: str, day: str | None):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ledger = V.events(spark, sf)
        if measure == "new_addresses" and day is None:
            ledger = entities.first_seen(ledger)
        elif measure == "new_addresses":
            ledger = V.first_seen_table(spark, sf, ("token_address",), view="events")
        return metrics.hourly_metric(ledger, V.event_spine(spark, sf), measure, day)

    return run


def _hourly_oracle(measure: str, day: str | None) -> str:
    source, table = E, "e"
    if measure == "new_addresses":
        source = f"{E}, {NEW_SQL.replace('FROM t', 'FROM e')}"
        table = "fs"
    on = "true" if day is None else f"transaction_date = DATE '{day}'"
    cut = "true" if day is None else f"h <= (SELECT max(dh) FROM {table} WHERE {on})"
    return f"""WITH {source}, {ES},
    s AS (SELECT token_address, transaction_date, lpad(CAST(n AS VARCHAR), 2, '0') AS h
          FROM es, unnest(range(24)) AS u(n) WHERE {on}),
    a AS (SELECT token_address, transaction_date, dh AS h, {AGGREGATE_SQL[measure]} AS v
          FROM {table} WHERE {on} GROUP BY ALL)
    SELECT coalesce(v, 0) AS value_num, token_address,
           concat(CAST(transaction_date AS VARCHAR), ' ', h, ':00:00') AS transaction_date,
           CAST(transaction_date AS VARCHAR) AS trade_date
    FROM s LEFT JOIN a USING (token_address, transaction_date, h) WHERE {cut}"""


for _measure in ("volume", "amount", "trades"):
    register(f"{_measure}_hour", _hourly(_measure, EVENT_DAY), _hourly_oracle(_measure, EVENT_DAY))
# All users of the event view are seen within its first days.
NEW_USER_DAY = "2024-01-02"
register(
    "new_addresses_hour_day", _hourly("new_addresses", NEW_USER_DAY), _hourly_oracle("new_addresses", NEW_USER_DAY)
)
register("new_addresses_hour_full", _hourly("new_addresses", None), _hourly_oracle("new_addresses", None))

# ------------------------------------------------- native new addresses, means

NATIVE_SQL = _first_seen_sql([], entities.BOTH_SIDES)
NATIVE_DAY = "1995-01-20"


def _native_seen(spark: SparkSession, sf: str, day: str | None = None) -> DataFrame:
    return entities.first_seen(V.transfers(spark, sf), []) if day is None else V.first_seen_table(spark, sf, ())


for _mode, _day in (("day", NATIVE_DAY), ("full", None)):
    register(
        f"native_new_addresses_{_mode}",
        lambda spark, sf, day=_day: metrics.new_addresses(_native_seen(spark, sf, day), day=day),
        f"""WITH {T}, {NATIVE_SQL} SELECT count(*) AS value_num, CAST(transaction_date AS VARCHAR) AS transaction_date
        FROM fs {'' if _day is None else f"WHERE transaction_date = DATE '{_day}'"} GROUP BY transaction_date""",
    )


def _average(column: str, positive: bool, day: str | None):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ledger, listed = V.transfers(spark, sf), V.transfer_spine(spark, sf)
        return metrics.avg_metric(ledger, listed, column, day, positive)

    return run


for _name, _column, _positive in (("avg_volume", "value", False), ("avg_amount", "amount", True)):
    for _mode, _day in (("day", DAY), ("full", None)):
        _on = "true" if _day is None else f"transaction_date = DATE '{_day}'"
        register(
            f"{_name}_{_mode}",
            _average(_column, _positive, _day),
            f"""WITH {T}, {SP},
            a AS (SELECT token_address, transaction_date, CAST(sum({_column}) AS DOUBLE) / count(*) AS v FROM t
                  WHERE {_on} {f'AND {_column} > 0' if _positive else ''} GROUP BY ALL)
            SELECT coalesce(v, 0) AS value_num, token_address, CAST(transaction_date AS VARCHAR) AS transaction_date
            FROM spine LEFT JOIN a USING (token_address, transaction_date) WHERE {_on}""",
        )

# ---------------------------------------------------------------------- flows


def _flow(side: str, day: str | None):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ledger = V.transfers(spark, sf)
        return flows.party_flow(ledger, V.exchanges(spark, sf), side, day)

    return run


for _name, _side in (("exchange_in", "to_address"), ("exchange_out", "from_address")):
    for _mode, _day in (("day", DAY), ("full", None)):
        register(
            f"{_name}_{_mode}",
            _flow(_side, _day),
            f"""WITH {T}, {V.EXCHANGES_SQL}
            SELECT CAST(sum(value) AS DOUBLE) AS value_num, {_side} AS address, token_address,
                   CAST(transaction_date AS VARCHAR) AS transaction_date
            FROM t WHERE {_side} IN (SELECT address FROM x)
            {'' if _day is None else f"AND transaction_date = DATE '{_day}'"}
            GROUP BY {_side}, token_address, transaction_date""",
        )

# --------------------------------------------------------------------- totals


def _total_native_day(spark: SparkSession, sf: str) -> DataFrame:
    return totals.running_total_day(_native_seen(spark, sf, NATIVE_DAY), V.total_table(spark, sf, False), NATIVE_DAY)


_TOTAL_NATIVE = f"""WITH {T}, {NATIVE_SQL},
  n AS (SELECT transaction_date, count(*) AS c FROM fs GROUP BY transaction_date),
  r AS (SELECT a.transaction_date, sum(b.c) AS v FROM n a JOIN n b ON b.transaction_date <= a.transaction_date GROUP BY 1)
  SELECT CAST(v AS BIGINT) AS value_num, CAST(transaction_date AS VARCHAR) AS transaction_date FROM r"""
register("total_addresses_native_full", lambda spark, sf: totals.running_total(_native_seen(spark, sf)), _TOTAL_NATIVE)
register(
    "total_addresses_native_day", _total_native_day, f"{_TOTAL_NATIVE} WHERE transaction_date = DATE '{NATIVE_DAY}'"
)

TOTAL_DAY = "1995-06-30"


def _total_token(day: str | None):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        listed = V.transfer_spine(spark, sf)
        if day is None:
            return totals.running_total_by_token(entities.first_seen(V.transfers(spark, sf)), listed)
        seen = V.first_seen_table(spark, sf, ("token_address",))
        return totals.running_total_by_token_day(seen, listed, V.total_table(spark, sf, True), day)

    return run


_TOTAL_TOKEN = f"""WITH {T}, {SP}, {NEW_SQL},
  n AS (SELECT token_address, transaction_date, count(*) AS c FROM fs GROUP BY ALL),
  r AS (SELECT token_address, transaction_date,
        sum(coalesce(c, 0)) OVER (PARTITION BY token_address ORDER BY transaction_date) AS v
        FROM spine LEFT JOIN n USING (token_address, transaction_date))
  SELECT CAST(v AS BIGINT) AS value_num, token_address, CAST(transaction_date AS VARCHAR) AS transaction_date FROM r"""
register("total_addresses_token_full", _total_token(None), _TOTAL_TOKEN)
register("total_addresses_token_day", _total_token(TOTAL_DAY), f"{_TOTAL_TOKEN} WHERE transaction_date = DATE '{TOTAL_DAY}'")

# ------------------------------------------------------------------- activity


def _activity(operator):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ledger = V.transfers(spark, sf)
        first_sent = V.first_seen_table(spark, sf, ("token_address",), ("from_address",))
        return operator(first_sent, ledger, V.transfer_spine(spark, sf), DAY)

    return run


register(
    "dormant_day",
    _activity(activity.dormant),
    f"""WITH {T}, {SP},
    l AS (SELECT from_address, token_address, max(transaction_date) AS d FROM t
          WHERE transaction_date <= DATE '{DAY}' GROUP BY ALL),
    a AS (SELECT token_address, count(*) AS v FROM l WHERE DATE '{DAY}' - d >= 61 GROUP BY ALL)
    SELECT coalesce(v, 0) AS value_num, token_address, CAST(transaction_date AS VARCHAR) AS transaction_date
    FROM spine LEFT JOIN a USING (token_address) WHERE transaction_date = DATE '{DAY}'""",
)
_AWAKENED = f"""WITH {T}, {SP},
  g AS (SELECT token_address, transaction_date,
        transaction_date - lag(transaction_date) OVER (PARTITION BY from_address, token_address
                                                       ORDER BY transaction_date) AS gap
        FROM (SELECT DISTINCT from_address, token_address, transaction_date FROM t)),
  a AS (SELECT token_address, transaction_date, count(*) AS v FROM g WHERE gap >= 62 GROUP BY ALL)
  SELECT coalesce(v, 0) AS value_num, token_address, CAST(transaction_date AS VARCHAR) AS transaction_date
  FROM spine LEFT JOIN a USING (token_address, transaction_date)"""
register("awakened_day", _activity(activity.awakened), f"{_AWAKENED} WHERE transaction_date = DATE '{DAY}'")
register(
    "awakened_full",
    lambda spark, sf: activity.awakened_history(V.transfers(spark, sf), V.transfer_spine(spark, sf)),
    _AWAKENED,
)

register(
    "dormant_full",
    lambda spark, sf: activity.dormant_history(V.transfers(spark, sf), V.transfer_spine(spark, sf)),
    f"""WITH {T}, {SP},
    s AS (SELECT token_address, transaction_date AS d, lead(transaction_date) OVER (
            PARTITION BY from_address, token_address ORDER BY transaction_date) AS following
          FROM (SELECT DISTINCT from_address, token_address, transaction_date FROM t)),
    i AS (SELECT token_address, d + 61 AS start, coalesce(following, DATE '9999-12-31') AS stop FROM s),
    a AS (SELECT spine.token_address, transaction_date, count(*) AS v FROM spine
          JOIN i ON i.token_address = spine.token_address AND start <= transaction_date AND transaction_date < stop GROUP BY ALL)
    SELECT coalesce(v, 0) AS value_num, token_address, CAST(transaction_date AS VARCHAR) AS transaction_date
    FROM spine LEFT JOIN a USING (token_address, transaction_date)""",
)

# ------------------------------------------------------------------- rankings


def _ranking(days_back: int, k: int):
    return lambda spark, sf: rankings.top_participants(V.transfers(spark, sf), DAY, days_back, k)


FULL_TOP = 10
for _name, _back, _k in (("day", 0, 100), ("week", 7, 100), ("month", 30, 100)):
    register(
        f"ranking_{_name}",
        _ranking(_back, _k),
        f"""WITH {T},
        p AS (SELECT from_address AS customer_address, token_address, transaction_date AS d FROM t
              UNION ALL SELECT to_address, token_address, transaction_date FROM t),
        c AS (SELECT count(*) AS value_num, customer_address, token_address FROM p
              WHERE d BETWEEN DATE '{DAY}' - {_back} AND DATE '{DAY}' GROUP BY ALL)
        SELECT value_num, customer_address, token_address, '{DAY}' AS transaction_date FROM c
        QUALIFY row_number() OVER (PARTITION BY token_address ORDER BY value_num DESC, customer_address) <= {_k}""",
    )
    # A report of ten a day: over all of history a hundred would hold nearly every address of a window.
    register(
        f"ranking_{_name}_full",
        lambda spark, sf, back=_back: rankings.top_participants_history(V.transfers(spark, sf), back, FULL_TOP),
        f"""WITH {T},
        p AS (SELECT from_address AS customer_address, token_address, transaction_date AS d FROM t
              UNION ALL SELECT to_address, token_address, transaction_date FROM t),
        m AS (SELECT max(d) AS latest FROM p),
        n AS (SELECT customer_address, token_address, d, count(*) AS c FROM p GROUP BY ALL),
        w AS (SELECT customer_address, token_address, d + CAST(u.i AS INT) AS d, c FROM n, unnest(range({_back + 1})) AS u(i)),
        c AS (SELECT sum(c) AS value_num, customer_address, token_address, d FROM w, m WHERE d <= latest GROUP BY ALL)
        SELECT CAST(value_num AS BIGINT) AS value_num, customer_address, token_address, CAST(d AS VARCHAR) AS transaction_date FROM c
        QUALIFY row_number() OVER (PARTITION BY token_address, d ORDER BY value_num DESC, customer_address) <= {FULL_TOP}""",
    )
