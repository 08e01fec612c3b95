"""Flows into and out of listed addresses."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.sums import sum_by
from ledgerlake.sources.readers import scan


def party_flow(
    ledger: DataFrame,
    listed: DataFrame,
    side: str = "to_address",
    day: str | dt.date | None = None,
    value: str = "value",
) -> DataFrame:
    """Summed value per listed address, token and day; ``side`` picks inflow (to) or outflow (from).

    The list filters before the aggregation, so only its rows are shuffled.
    """
    if day is not None:
        ledger = scan(ledger, on=day)
    wanted = listed.select(F.col("address").alias(side))
    summed = sum_by(ledger.join(wanted, side, "left_semi"), [side, "token_address", "transaction_date"], value)
    total = F.coalesce("total", F.lit(0.0)).alias("value_num")
    return summed.select(total, F.col(side).alias("address"), "token_address", "transaction_date")
