"""Native-asset ledger: fees, rewards, value movements, pricing."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.dates import hour_key
from ledgerlake.functions.numbers import add_text, exact_amount, integer_text, plain_decimal, shift_point, to_bigint, wei_to_units
from ledgerlake.operators.sums import add_up

# Block reward from each height on, and the sender of minted units.
REWARD_STEPS = ((0, 5), (4_370_000, 3), (7_080_001, 2))
MINT_ADDRESS = "0x^0"
UNCLE_BONUS = Decimal("0.03125")

MOVEMENT = (
    "block_number",
    "from_address",
    "to_address",
    "value",
    "transaction_index",
    "transaction_hash",
    "date_time",
    "transaction_type",
    "transaction_date",
)


def step_lookup(col: Column, steps: Sequence[tuple[int, int]]) -> Column:
    """Value of the highest step whose start is at or below ``col``."""
    (_, value), *higher = sorted(steps)
    chosen = F.lit(value)
    for start, value in higher:
        chosen = F.when(col >= start, F.lit(value)).otherwise(chosen)
    return chosen


def block_fees(transactions: DataFrame) -> DataFrame:
    """Sum of gas used x gas price per block, in units; a blank on either side counts as 0.

    Products and their sum are exact, then scaled once.
    """
    zero = F.lit("0")
    gas = F.coalesce(plain_decimal(F.col("base_gas_used")), zero)
    price = F.coalesce(plain_decimal(integer_text(F.col("base_gas_price"))), zero)
    # Each text is worked out once, as a column of its own; what fits is one decimal product.
    parsed = transactions.select("block_number", F.explode(F.array(F.struct(gas.alias("gas"), price.alias("price")))).alias("x"))
    gas, price = F.col("x.gas"), F.col("x.price")
    short = gas.rlike("^[0-9]{1,19}$") & price.rlike("^[0-9]{1,19}$")
    product = (gas.cast("decimal(19,0)") * price.cast("decimal(19,0)")).cast("string")
    charged = parsed.select("block_number", F.when(short, product).otherwise(exact_amount(gas, price)).alias("fee"))
    return add_up(charged, ["block_number"], "fee").select(
        "block_number", shift_point(F.col("total"), F.lit(18)).alias("service_charge")
    )


def _reward(col: Column, steps: Sequence[tuple[int, int]]) -> Column:
    return step_lookup(col, steps).cast("decimal(10,0)")


def uncle_rewards(uncles: DataFrame, steps: Sequence[tuple[int, int]] = REWARD_STEPS) -> DataFrame:
    """(uncle number + 8 - block number) x reward / 8, to the uncle's miner."""
    distance = (to_bigint(F.col("uncles_number")) + 8 - F.col("block_number")).cast("decimal(19,0)")
    value = distance * _reward(F.col("block_number"), steps) * F.lit(Decimal("0.125"))
    return uncles.select(
        "block_number",
        F.lit(MINT_ADDRESS).alias("from_address"),
        F.col("uncles_miner").alias("to_address"),
        plain_decimal(value).alias("value"),
        F.lit("").alias("transaction_index"),
        F.lit("").alias("transaction_hash"),
        "date_time",
        F.lit("uncles").alias("transaction_type"),
        "transaction_date",
    )


def block_rewards(
    blocks: DataFrame, uncles: DataFrame, fees: DataFrame, steps: Sequence[tuple[int, int]] = REWARD_STEPS
) -> DataFrame:
    """Reward + 1/32 of it per uncle + fees, to the block's miner; a missing part counts as 0."""
    counts = uncles.groupBy("block_number").agg(F.count("*").alias("uncle_count"))
    reward = _reward(F.col("block_number"), steps)
    bonus = reward * F.lit(UNCLE_BONUS) * F.coalesce("uncle_count", F.lit(0)).cast("decimal(10,0)")
    minted = plain_decimal(reward + bonus)
    value = F.when(F.col("service_charge").isNull(), minted).otherwise(add_text(minted, F.col("service_charge")))
    return (
        blocks.select("block_number", F.col("miner").alias("to_address"), "date_time", "transaction_date")
        .join(counts, "block_number", "left")
        .join(fees, "block_number", "left")
        .select(
            "block_number",
            F.lit(MINT_ADDRESS).alias("from_address"),
            "to_address",
            value.alias("value"),
            F.lit("").alias("transaction_index"),
            F.lit("").alias("transaction_hash"),
            "date_time",
            F.lit("reward_charge").alias("transaction_type"),
            "transaction_date",
        )
    )


def _movements(df: DataFrame, prefix: str, kind: str) -> DataFrame:
    column = lambda name: F.col(f"{prefix}_{name}")
    return df.where((column("error") == "") & (column("from") != "") & (column("to") != "")).select(
        "block_number",
        column("from").alias("from_address"),
        column("to").alias("to_address"),
        wei_to_units(column("value")).alias("value"),
        column("transaction_index").alias("transaction_index"),
        column("transaction_hash").alias("transaction_hash"),
        "date_time",
        F.lit(kind).alias("transaction_type"),
        "transaction_date",
    )


def trace_movements(traces: DataFrame) -> DataFrame:
    """External transfers: error-free traces with both parties."""
    return _movements(traces, "trace", "trace")


def call_movements(calls: DataFrame) -> DataFrame:
    """Internal transfers: error-free calls with both parties."""
    return _movements(calls, "calls", "calls")


def native_ledger(
    blocks: DataFrame,
    transactions: DataFrame,
    uncles: DataFrame,
    traces: DataFrame,
    calls: DataFrame,
    steps: Sequence[tuple[int, int]] = REWARD_STEPS,
) -> DataFrame:
    """All native movements as one bag, tagged by kind."""
    return (
        block_rewards(blocks, uncles, block_fees(transactions), steps)
        .unionByName(uncle_rewards(uncles, steps))
        .unionByName(trace_movements(traces))
        .unionByName(call_movements(calls))
    )


def price_ledger(ledger: DataFrame, prices: DataFrame, asset: str = "ethereum") -> DataFrame:
    """The asset's daily price and value x price; a day without price counts as price 0."""
    daily = prices.where(F.col("id") == asset).select("price_us", "transaction_date")
    priced = (
        ledger.join(daily, "transaction_date", "left")
        .withColumn("price_us", F.coalesce("price_us", F.lit(0).cast("decimal(1,0)")))
        .withColumn("amount", exact_amount(F.col("value"), F.col("price_us")))
    )
    return priced.select(
        "block_number",
        "from_address",
        "to_address",
        "value",
        "price_us",
        "amount",
        "transaction_index",
        "transaction_hash",
        hour_key(F.col("date_time")).alias("dh"),
        "date_time",
        "transaction_type",
        "transaction_date",
    )
