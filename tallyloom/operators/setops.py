"""Unions of flows and merge into a target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_branches(branches: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name of branches with the same columns."""
    return reduce(lambda a, b: a.unionByName(b), branches)


def align_union(a: DataFrame, b: DataFrame, zero_columns: Sequence[str] = ()) -> DataFrame:
    """Union two flows with different columns.

    Names compare without case. A column one side lacks is null there, or 0.0
    if it is one of ``zero_columns`` and missing from the first flow.
    """
    have = {c.lower() for c in a.columns}
    extra = {c: F.lit(0.0) for c in zero_columns if c.lower() not in have}
    left = a.withColumns(extra) if extra else a
    return left.unionByName(b, allowMissingColumns=True)


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str], insert: Mapping[str, object] | None = None
) -> DataFrame:
    """Update matched rows, insert new ones, keep the rest.

    Keys may be null and then compare as equal; the source has one row per
    key. ``insert`` gives target columns the source does not have.
    """
    src = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], F.lit(True).alias("_in_source"))
    tgt = target.withColumn("_in_target", F.lit(True))
    condition = None
    for k in keys:
        part = tgt[k].eqNullSafe(src[f"_s_{k}"])
        condition = part if condition is None else condition & part
    joined = tgt.join(src, condition, "full")
    matched = F.col("_in_source").isNotNull()
    new_row = F.col("_in_target").isNull()
    available = set(source.columns)
    result = []
    for c in target.columns:
        if c in keys or (c not in update and c in available):
            result.append(F.when(new_row, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        elif c in update:
            result.append(F.when(matched, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        else:
            default = F.lit((insert or {}).get(c)).cast(target.schema[c].dataType)
            result.append(F.when(new_row, default).otherwise(F.col(c)).alias(c))
    return joined.select(*result)
