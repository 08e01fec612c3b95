"""Daily and backfill runs over a layered warehouse of Parquet tables.

Each step reads tables, applies operators and replaces the touched partitions;
running a day again gives the same tables. A layer is written before the next
one reads it, so a lost executor costs no more than the step it was lost in.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.dates import as_date
from ledgerlake.operators import activity, calls, entities, flows, metrics, native, parse, rankings, totals, transfers
from ledgerlake.operators.documents import parse_documents
from ledgerlake.sources.readers import between_days, read_raw, scan
from ledgerlake.sources.sinks import write_partitions
from ledgerlake.sources.windows import Windows, backfill

DATE = "transaction_date"
PARSERS = {
    "block": parse.parse_blocks,
    "base": parse.parse_transactions,
    "receipt": parse.parse_receipts,
    "logs": parse.parse_logs,
    "trace": parse.parse_traces,
    "calls": calls.flatten_calls,
    "uncles": parse.parse_uncles,
}
RANKINGS = (("day", 0), ("week", 7), ("month", 30))
DOCUMENT = "document"  # the nested table that the parts are read from
Day = str | dt.date | None


@dataclass(frozen=True)
class Warehouse:
    """Tables below ``root``: ``stage`` (fresh), ``ods`` (promoted), ``dwd`` (ledgers, first seen), ``dw`` (metrics).

    Dimensions (``dm/token_address``, ``dm/token_price``, ``dm/token_list``,
    ``dm/exchange_address``) are inputs. A ``day`` of None means all of history.
    """

    spark: SparkSession
    root: str
    windows: Windows = field(default_factory=Windows)

    def read(self, table: str) -> DataFrame:
        try:
            return self.spark.read.parquet(f"{self.root}/{table}")
        except AnalysisException as error:
            layer, name = table.split("/")
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA" or name not in {**PARSERS, DOCUMENT: None}:
                raise
            # Written, but no block had such a part yet: no file to take the columns from.
            none = parse_documents(parse.envelope(self.spark.createDataFrame([], "info string")))
            none = none if name == DOCUMENT else PARSERS[name](none)
            return none.drop("dh") if layer == "ods" else none

    def known(self, table: str, like: DataFrame) -> DataFrame:
        """The table, or no rows when it was never written."""
        try:
            return self.read(table)
        except AnalysisException:
            return like.limit(0)

    def write(self, df: DataFrame, table: str, by: tuple[str, ...] = (DATE,)) -> None:
        """Replace the partitions the rows belong to; rows without a date share the default partition."""
        write_partitions(df, f"{self.root}/{table}", by)

    def since(self, layer: str, day: Day) -> dt.date | None:
        return None if day is None else self.windows.since(layer, day)

    # ---------------------------------------------------------------- layers

    def load_raw(self, raw_root: str, day: str | dt.date, files: str = "*.log") -> None:
        """Lines that arrived in the last days to the source table."""
        lines = parse.envelope(read_raw(self.spark, raw_root, day, self.windows.raw, files))
        self.write(scan(lines, since=self.since("parse", day)), "stage/source")
        # Undated and malformed documents stay in reach, under the day of the run.
        self.write(calls.quarantine(lines).withColumn("run_date", F.lit(as_date(day))), "stage/quarantine", ("run_date",))

    def load_documents(self, documents: DataFrame) -> None:
        """Backfill of the source table from a frame of documents."""
        self.write(parse.envelope(documents), "stage/source")

    def backfill_ods(self, month: str | None = None, day: str | None = None) -> None:
        """One month, or one day, of the fresh tables anew to the promoted ones."""
        for table in ("source", *PARSERS):
            self.write(backfill(self.read(f"stage/{table}"), month, day).drop("dh"), f"ods/{table}")

    def parse_stage(self, day: Day = None) -> None:
        """The documents parsed once, then each part from the nested table's own columns."""
        since = self.since("parse", day)
        self.write(parse_documents(scan(self.read("stage/source"), since=since)), f"stage/{DOCUMENT}")
        documents = scan(self.read(f"stage/{DOCUMENT}"), since=since)
        for table, parser in PARSERS.items():
            self.write(parser(documents), f"stage/{table}")

    def promote_ods(self, day: Day = None) -> None:
        for table in ("source", *PARSERS):
            rows = scan(self.read(f"stage/{table}"), since=self.since("ods", day))
            self.write(rows.drop("dh"), f"ods/{table}")

    def build_transfers(self, day: Day = None) -> None:
        recent = lambda table: scan(self.read(f"stage/{table}"), since=self.since("ledger", day))
        built = transfers.token_transfers(
            recent("logs"), recent("receipt"), recent("trace"), self.read("dm/token_address"), self.read("dm/token_price")
        )
        self.write(built, "dwd/token_transaction")

    def build_native(self, day: Day = None) -> None:
        recent = lambda table: scan(self.read(f"ods/{table}"), on=day)
        ledger = native.native_ledger(*(recent(t) for t in ("block", "base", "uncles", "trace", "calls")))
        self.write(native.price_ledger(ledger, self.read("dm/token_price")), "dwd/transaction")

    def build_first_seen(self, day: Day = None) -> None:
        for table, ledger, keys, sides in (
            ("to_address", "transaction", [], entities.BOTH_SIDES),
            ("token_to_address", "token_transaction", ["token_address"], entities.BOTH_SIDES),
            ("token_from_address", "token_transaction", ["token_address"], ("from_address",)),
        ):
            rows = self.read(f"dwd/{ledger}")
            if day is None:
                fresh = entities.first_seen(rows, keys, sides)
            else:
                known = self.known(f"dwd/{table}", entities.first_seen(rows, keys, sides))
                fresh = entities.first_seen(rows, keys, sides, day, known)
            self.write(fresh, f"dwd/{table}")

    # --------------------------------------------------------------- metrics

    def build_metrics(self, day: Day = None) -> None:
        """All per-token and native metrics of a day, or of all of history."""
        moves, listed = self.read("dwd/token_transaction"), self.read("dm/token_list")
        seen, seen_native = self.read("dwd/token_to_address"), self.read("dwd/to_address")
        for measure in metrics.MEASURES:
            ledger = seen if measure == "new_addresses" else moves
            for grain in ("day", "week", "month"):
                self.write(metrics.rollup_metric(ledger, listed, measure, grain, day), f"dw/{measure}_{grain}")
            if day is not None or measure == "new_addresses":
                hourly = metrics.hourly_metric(ledger, listed, measure, day)
                self.write(hourly, f"dw/{measure}_hour", ("trade_date",))
        self.write(metrics.new_addresses(seen_native, day=day), "dw/native_new_addresses")
        self.write(metrics.avg_metric(moves, listed, "value", day), "dw/avg_volume")
        self.write(metrics.avg_metric(moves, listed, "amount", day, positive=True), "dw/avg_amount")
        exchanges = self.read("dm/exchange_address")
        self.write(flows.party_flow(moves, exchanges, "to_address", day), "dw/exchange_in")
        self.write(flows.party_flow(moves, exchanges, "from_address", day), "dw/exchange_out")
        self._totals(seen, seen_native, listed, day)
        if day is not None:
            self._activity(moves, listed, day)
            return
        self.write(activity.dormant_history(moves, listed), "dw/dormant")
        self.write(activity.awakened_history(moves, listed), "dw/awakened")
        for name, days_back in RANKINGS:
            self.write(rankings.top_participants_history(moves, days_back), f"dw/ranking_{name}")

    def _totals(self, seen: DataFrame, seen_native: DataFrame, listed: DataFrame, day: Day) -> None:
        if day is None:
            self.write(totals.running_total(seen_native), "dw/total_addresses_native")
            self.write(totals.running_total_by_token(seen, listed), "dw/total_addresses_token")
            return
        upto = between_days(seen, DATE, None, as_date(day))
        prior_native = self.known("dw/total_addresses_native", totals.running_total(seen_native.where(upto)))
        self.write(totals.running_total_day(seen_native, prior_native, day), "dw/total_addresses_native")
        prior = self.known("dw/total_addresses_token", totals.running_total_by_token(seen, listed))
        self.write(totals.running_total_by_token_day(seen, listed, prior, day), "dw/total_addresses_token")

    def _activity(self, moves: DataFrame, listed: DataFrame, day: str | dt.date) -> None:
        first_sent = self.read("dwd/token_from_address")
        self.write(activity.dormant(first_sent, moves, listed, day), "dw/dormant")
        self.write(activity.awakened(first_sent, moves, listed, day), "dw/awakened")
        for name, days_back in RANKINGS:
            self.write(rankings.top_participants(moves, day, days_back), f"dw/ranking_{name}")

    def run_ledgers(self, day: Day = None) -> None:
        """Everything after the source table up to the first-seen tables."""
        for step in (self.parse_stage, self.promote_ods, self.build_transfers, self.build_native, self.build_first_seen):
            step(day)
