"""Token transfers: select, decode, validate and price log events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.dates import hour_key
from ledgerlake.functions.numbers import exact_amount, hex_to_decimal, integer_text, unit_scale_text

# Fixed value: first topic of a token Transfer event.
TRANSFER_TOPIC = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
ADDRESS_DIGITS = 40


def topic_list() -> Column:
    return F.from_json("logs_topics", "array<string>")


def select_transfer_logs(logs: DataFrame, tokens: DataFrame, topic: str = TRANSFER_TOPIC) -> DataFrame:
    """Transfer events with both parties indexed, of tokens in the dimension."""
    both_parties = F.size(topic_list()) >= 3  # the event and its two indexed parties
    wanted = (F.col("logs_address") != "") & (F.col("logs_topics_one") == topic) & both_parties
    return logs.where(wanted).join(tokens.select(F.col("address").alias("logs_address")), "logs_address", "left_semi")


def decode_transfers(logs: DataFrame) -> DataFrame:
    """Parties from topics 1 and 2, raw value (exact digits) from the data word."""
    party = lambda n: F.concat(F.lit("0x"), F.right(F.get("_topics", F.lit(n)), F.lit(ADDRESS_DIGITS)))
    return logs.withColumn("_topics", topic_list()).select(
        "block_number",
        "logs_address",
        party(1).alias("from_address"),
        party(2).alias("to_address"),
        integer_text(F.col("logs_data")).alias("value"),
        "logs_transaction_index",
        "logs_transaction_hash",
        "date_time",
        "transaction_date",
    )


def _plain_index(column: str) -> Column:
    col = F.col(column)
    return F.when(col.startswith("0x"), hex_to_decimal(col)).otherwise(col)


def valid_transfers(transfers: DataFrame, receipts: DataFrame, traces: DataFrame) -> DataFrame:
    """Transfers whose transaction has a receipt that did not fail and a trace without error.

    Two semi joins on the same four keys: the transfers are shuffled once for
    both, and a duplicated receipt or trace cannot multiply a transfer.
    """
    keys = ["block_number", "transaction_date", "logs_transaction_index", "logs_transaction_hash"]
    good_receipts = receipts.where(F.col("receipt_status") != "false").select(
        "block_number",
        "transaction_date",
        F.col("receipt_transaction_index").alias("logs_transaction_index"),
        F.col("receipt_transaction_hash").alias("logs_transaction_hash"),
    )
    good_traces = traces.where(F.col("trace_error") == "").select(
        "block_number",
        "transaction_date",
        _plain_index("trace_transaction_index").alias("logs_transaction_index"),
        F.col("trace_transaction_hash").alias("logs_transaction_hash"),
    )
    return transfers.join(good_receipts, keys, "left_semi").join(good_traces, keys, "left_semi")


def enrich_transfers(transfers: DataFrame, tokens: DataFrame, prices: DataFrame) -> DataFrame:
    """Token id, symbol and scale, the day's price, and value x price.

    Value and amount are exact plain text, whatever their length. A day without
    price leaves price and amount null. Both dimensions are left to the optimizer: it broadcasts them only below the
    session's size threshold, and splits hot tokens otherwise.
    """
    dim = tokens.select(
        F.col("id").alias("token_id"), F.col("address").alias("logs_address"), "decimals", "token_symbol"
    )
    daily = prices.select(F.col("id").alias("token_id"), F.col("price_us"), "transaction_date")
    joined = (
        transfers.withColumnRenamed("value", "raw_value")
        .join(dim, "logs_address", "left")
        .join(daily, ["token_id", "transaction_date"], "left")
        .withColumn("value", unit_scale_text(F.col("raw_value"), F.col("decimals")))
        .withColumn("amount", exact_amount(F.col("value"), F.col("price_us")))
    )
    return joined.select(
        "block_number",
        "from_address",
        "to_address",
        "value",
        "price_us",
        "amount",
        "logs_transaction_index",
        "logs_transaction_hash",
        hour_key(F.col("date_time")).alias("dh"),
        "date_time",
        "token_id",
        "token_symbol",
        F.col("logs_address").alias("token_address"),
        "transaction_date",
    )


def token_transfers(
    logs: DataFrame, receipts: DataFrame, traces: DataFrame, tokens: DataFrame, prices: DataFrame
) -> DataFrame:
    """Logs to priced transfers in one plan."""
    decoded = decode_transfers(select_transfer_logs(logs, tokens))
    return enrich_transfers(valid_transfers(decoded, receipts, traces), tokens, prices)


def price_by_symbol(tokens: DataFrame, ids: DataFrame, prices: DataFrame) -> DataFrame:
    """Symbol to asset id to daily price; symbols without id or price drop out.

    ``tokens`` has ``token_symbol``; ``ids`` has ``token_symbol, id``; ``prices``
    has ``id, price_us, transaction_date``.
    """
    return (
        tokens.join(ids.select("token_symbol", "id"), "token_symbol")
        .join(prices.select("id", "price_us", "transaction_date"), "id")
        .select("id", "token_symbol", "price_us", "transaction_date")
    )
