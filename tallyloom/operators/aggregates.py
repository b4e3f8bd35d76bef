"""Group sums, roll-ups, conditional measures and totals.

Sums of doubles depend on the order of their rows, which differs from run to
run. Here every amount is brought to a whole number of millionths first, and
whole numbers are added: the result is the same for every order, partitioning
and number of levels, and differs from the true sum by at most half a millionth
for each row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import column
from tallyloom.operators.sizing import fits_broadcast
from tallyloom.session import scratch_table

UNITS = 1_000_000.0
# Scaled amounts are summed in two whole numbers, above and below this power of
# two: the lower one holds some 10 ** 12 rows, the upper one totals of LARGEST.
_SPLIT = 1 << 20
# Larger amounts are an error, not a wrong sum.
LARGEST = 9.0e18


def _halves(value: Column) -> tuple[Column, Column]:
    """An amount in millionths as two whole numbers."""
    amount = value.cast("double")
    fits = F.when(F.abs(amount) <= LARGEST, amount).when(amount.isNotNull(), F.raise_error(F.lit("amount out of range for a sum")).cast("double"))
    scaled = fits * UNITS
    upper = F.floor(scaled / float(_SPLIT))
    # The difference is exact: both have the same last binary digit.
    lower = F.floor(scaled - upper.cast("double") * float(_SPLIT) + 0.5)
    return upper, lower


def _whole(upper: Column, lower: Column) -> Column:
    high, low = upper.cast("decimal(20,0)"), lower.cast("decimal(20,0)")
    return (high * F.lit(_SPLIT).cast("decimal(8,0)") + low).cast("double") / UNITS


def exact_sum(value: Column) -> Column:
    """Sum of amounts that does not depend on their order; null where all are null."""
    upper, lower = _halves(value)
    return _whole(F.sum(upper), F.sum(lower))


def exact_pair(a: Column, b: Column) -> Column:
    """What ``exact_sum`` gives for two amounts in rows of their own."""
    (upper, lower), (upper_b, lower_b) = _halves(a), _halves(b)
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(_whole(upper + upper_b, lower + lower_b))


def exact_value(value: Column) -> Column:
    """What ``exact_sum`` gives for a single amount."""
    return _whole(*_halves(value))


def sum_of(df: DataFrame, name: str) -> Column:
    """The sum of a column: exact for fractions, plain for whole numbers."""
    kind = df.select(F.col(name)).dtypes[0][1]
    return exact_sum(F.col(name)) if kind in ("double", "float") else F.sum(name)


def group_sum(df: DataFrame, keys: Sequence[str], measures: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Sum measures per key; a mapping renames them (source to result)."""
    named = dict(measures) if isinstance(measures, Mapping) else {m: m for m in measures}
    return df.groupBy(*keys).agg(*[sum_of(df, src).alias(out) for src, out in named.items()])


def group_sum_of_few(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """As ``group_sum``, where most rows are a group of their own and are read back from files.

    Only a digest of each row's keys is shuffled at first. A row whose digest
    no other row has is a whole group and stays where it is; the others, equal
    keys or not, are grouped by all keys. Digests that several rows share are
    kept as a table; where it outgrows a broadcast, all rows are grouped.
    """
    kinds = dict(df.dtypes)
    # Zeros compare as equal in a group whatever their sign: it must not tell digests apart.
    zeros = {k: F.when(F.col(k) == 0, F.lit(0.0).cast(kinds[k])).otherwise(F.col(k)) for k in keys if kinds[k] in ("double", "float")}
    marked = df.withColumns(zeros).withColumn("_digest", F.xxhash64(*keys))
    counted = marked.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n"))
    shared = scratch_table(counted.where(F.col("_n") > 1).select("_digest"), "digests")
    if not fits_broadcast(shared):
        return group_sum(df, keys, measures)
    grouped = group_sum(marked.join(F.broadcast(shared), "_digest", "left_semi"), keys, measures)
    types = dict(grouped.dtypes)
    values = [exact_value(F.col(m)) if kinds[m] in ("double", "float") else F.col(m).cast(types[m]) for m in measures]
    alone = marked.join(F.broadcast(shared), "_digest", "left_anti")
    return alone.select(*keys, *[v.alias(m) for v, m in zip(values, measures)]).unionByName(grouped)


def rollup_to(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Re-aggregate partial sums to a coarser grain, null sums counting as zero.

    The finer frame is used directly; nothing is written and read back.
    """
    return df.groupBy(*keys).agg(*[F.coalesce(sum_of(df, m), F.lit(0.0)).alias(m) for m in measures])


def group_max(df: DataFrame, keys: Sequence[str], values: Sequence[str], where: Column | None = None) -> DataFrame:
    source = df if where is None else df.where(where)
    return source.groupBy(*keys).agg(*[F.max(v).alias(v) for v in values])


def group_attributes(
    df: DataFrame, keys: Sequence[str], attributes: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Sum measures per key and carry attributes that the key determines.

    The attributes are carried as ``max``, so the shuffle key stays short.
    """
    return df.groupBy(*keys).agg(
        *[F.max(a).alias(a) for a in attributes], *[sum_of(df, m).alias(m) for m in measures]
    )


def conditional_sums(df: DataFrame, keys: Sequence[str], measures: Mapping[str, tuple[Column, Column | None]]) -> DataFrame:
    """One pass over the input: per measure, the sum of an expression where a condition holds."""

    def one(expression: Column, condition: Column | None) -> Column:
        value = column(expression).cast("double")
        return exact_sum(value if condition is None else F.when(condition, value).otherwise(F.lit(0.0)))

    return df.groupBy(*keys).agg(*[one(e, c).alias(name) for name, (e, c) in measures.items()])


def grouping_sets_total(df: DataFrame, keys: Sequence[str], detail: str, value: str, total_id: str) -> DataFrame:
    """Detail sums and totals as two grouping sets over one scan."""
    columns = [F.col(k) for k in keys]
    sets = [[*columns, F.col(detail)], columns]
    return (
        df.groupingSets(sets, *columns, F.col(detail))
        .agg(sum_of(df, value).alias("_sum"), F.grouping(detail).alias("_g"))
        .select(
            *keys,
            F.when(F.col("_g") == 1, F.lit(total_id)).otherwise(F.col(detail)).alias(detail),
            F.col("_sum").alias(value),
        )
    )
