"""Registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, TimestampNTZType

from ledgerlake.functions.numbers import plain_decimal
from ledgerlake.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def present(df: DataFrame) -> DataFrame:
    """Dates, times, flags and decimals as text, so that any client shows the same values."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            column = plain_decimal(column)
        elif isinstance(field.dataType, (DateType, TimestampNTZType, BooleanType)):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def register(name: str, query: Query, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(query(tune(spark), sf_dir))

    QUERIES[name] = run
    if sql is not None:
        ORACLES[name] = sql
