"""Exact sums of numbers in text form, of any width.

A number becomes a row for each stretch of 18 digits that it fills (one row for a
whole number of up to 28 digits). Stretches are added up by key and place, then
put together once per key: nothing is padded or cut to a width, and the map-side
sum shrinks a frequent key to a few rows a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerlake.functions.numbers import limbs_text, number_limbs, sum_exact


def add_up(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """The keys, ``total`` (plain text; null if no row has a number) and ``n``, the number of rows."""
    rows = df.select(*keys, F.posexplode_outer(number_limbs(F.col(column))).alias("_at", "_limb"))
    one = F.coalesce(F.col("_at"), F.lit(0)) == 0  # the first stretch stands for the row
    placed = rows.groupBy(*keys, F.col("_limb.place").alias("_place")).agg(
        F.sum("_limb.part").alias("_part"), F.count_if(one).alias("_n")
    )
    parts = F.when(F.col("_place").isNotNull(), F.struct(F.col("_place").alias("place"), F.col("_part").alias("part")))
    gathered = placed.groupBy(*keys).agg(F.sort_array(F.collect_list(parts)).alias("_parts"), F.sum("_n").alias("n"))
    return gathered.select(*keys, limbs_text(F.col("_parts")).alias("total"), "n")


def sum_by(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """The keys, ``total`` as double (null if no row has a number) and ``n``, whatever the type of the column."""
    if isinstance(df.schema[column].dataType, StringType):
        return add_up(df, keys, column).withColumn("total", F.col("total").cast("double"))
    total: Column = sum_exact(df, column)
    return df.groupBy(*keys).agg(total.alias("total"), F.count("*").alias("n"))
