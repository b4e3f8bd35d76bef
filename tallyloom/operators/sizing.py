"""Size checks that decide whether a side may be broadcast."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side above this planned size is never broadcast by our own hint. Planned
# sizes start from files, which hold rows packed: the driver collects plain rows
# and builds their hash table, which takes some ten times as much.
BROADCAST_LIMIT_BYTES = 8 * 1024 * 1024


def planned_bytes(df: DataFrame) -> int:
    """Size of a frame as the optimizer estimates it; unknown counts as too large."""
    if not hasattr(df, "_jdf"):
        return sys.maxsize
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    return planned_bytes(df) <= (BROADCAST_LIMIT_BYTES if limit is None else limit)


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Hint a broadcast for a side of proven size.

    Anything larger is returned as it is: Spark then shuffles both sides and
    adaptive execution splits skewed partitions.
    """
    return F.broadcast(df) if fits_broadcast(df, limit) else df
