"""Row counts and uniqueness without extra jobs per stage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, label: str) -> tuple[DataFrame, Observation]:
    """Count rows while they pass; read ``.get`` after the action has run."""
    observation = Observation(label)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def layer_row_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """One row per layer with its row count, in one job."""
    counted = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("layer"), "n_rows") for n, df in layers.items()]
    result = counted[0]
    for c in counted[1:]:
        result = result.unionByName(c)
    return result


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once: empty when a key is unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
