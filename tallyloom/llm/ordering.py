"""Places in a global order without a sort in one task.

Rows are range-sorted and written with the part they fall in and their index in
it. Only one row per part (and group) is needed to turn these into ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.sizing import broadcast_if_small
from tallyloom.session import scratch_table

_INDEX_BITS = 33


def numbered(df: DataFrame, label: str, name: str = "row") -> DataFrame:
    """The rows, written, with a number of their own that breaks ties.

    The number is fixed by the writing, so later jobs see the same one.
    """
    return scratch_table(df.withColumn(name, F.monotonically_increasing_id()), label)


def range_marked(df: DataFrame, by: Sequence[Column]) -> DataFrame:
    """The rows in order, with ``part`` and ``place`` (index within it); they hold for one reading only."""
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("mark", F.monotonically_increasing_id())
    marked = ordered.select("*", F.shiftright("mark", _INDEX_BITS).alias("part"), F.col("mark").bitwiseAND((1 << _INDEX_BITS) - 1).alias("place"))
    return marked.drop("mark")


def range_sorted(df: DataFrame, by: Sequence[Column], label: str) -> DataFrame:
    """The rows of ``range_marked``, written."""
    return scratch_table(range_marked(df, by), label)


def ranked(placed: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Adds ``rank`` (from 0) and ``total`` of the rows of ``range_sorted`` within groups that are never null.

    The sort must have had the groups as its first keys. The windows hold one
    row per part and group.
    """
    parts = placed.groupBy(*within, "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy(*within).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*within)
    begins = parts.select(
        *within, "part",
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("total"),
    )
    begins = scratch_table(begins, "begins")
    return placed.join(broadcast_if_small(begins), [*within, "part"]).withColumn("rank", F.col("place") + F.col("shift")).drop("shift")
