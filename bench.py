"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the cores. Every query is run in full into a sink that drops the
rows. A first run on the same data warms the JVM; the best of the following
runs counts.
"""

from __future__ import annotations

import json
import os
import shutil
import tempfile
import time

from ledgerlake.operators import entities
from ledgerlake.plans import catalog, views
from ledgerlake.session import local_session

HEADLINE = (
    "trades_day_full",
    "volume_day_full",
    "volume_all_grains",
    "amount_month_full",
    "new_addresses_day_full",
    "volume_hour",
    "first_seen_address_full",
    "first_seen_token_full",
    "first_seen_token_day",
    "exchange_in_full",
    "total_addresses_token_full",
    "dormant_day",
    "awakened_day",
    "awakened_full",
    "ranking_month",
    "parse_transactions",
    "parse_logs",
    "flatten_calls",
    "transfer_enrich",
    "native_ledger",
    "write_dynamic_overwrite",
)
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    shared = tempfile.mkdtemp(prefix="ledgerlake-bench-")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), shared=shared)
    seconds: dict[str, float] = {}
    # Tables that are written once and read by many queries have lines of their own.
    staging = {
        "stage_source": lambda: views.source_table(spark, sf_dir),
        "stage_parts": lambda: [views.part_table(spark, sf_dir, name) for name in views.PARSERS],
        "stage_prices": lambda: (views.token_prices(spark, sf_dir), views.native_prices(spark, sf_dir)),
        "stage_lists": lambda: (views.transfer_spine(spark, sf_dir), views.event_spine(spark, sf_dir)),
        "stage_first_seen": lambda: [
            views.first_seen_table(spark, sf_dir, keys, sides)
            for keys, sides in (
                (("token_address",), entities.BOTH_SIDES),
                (("token_address",), ("from_address",)),
                ((), entities.BOTH_SIDES),
            )
        ],
    }
    for name, build in staging.items():
        start = time.perf_counter()
        build()
        seconds[name] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        taken = []
        for _ in range(1 + RUNS):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(min(taken[1:]), 3)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds[name] for name in HEADLINE), 3),  # staging not included
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    shutil.rmtree(shared, ignore_errors=True)
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
