"""Joins of month-end reporting: effective-dated, banded, re-keying, lookups.

Nothing here forces a broadcast of a side that was not size-checked. Fact
sides stay on the left, where adaptive execution can split a hot key; the
right side holds one row per key, so a hot key never multiplies.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.asof import versions_on
from tallyloom.operators.filters import valid_on
from tallyloom.operators.intervals import band_join, in_band  # noqa: F401  joins like the others
from tallyloom.operators.sizing import broadcast_if_small, fits_broadcast
from tallyloom.session import scratch_table


def _prefixed(df: DataFrame, prefix: str, keep: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in keep])


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    defaults: Mapping[str, object] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Left join to a frame with one row per key, then fill what did not match.

    ``on`` is a key list, or a mapping from fact column to dimension column.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    keys = {d: f"_k{i}" for i, d in enumerate(pairs.values())}
    right = broadcast_if_small(dim, limit).withColumnsRenamed(keys)
    condition = None
    for fact_col, dim_col in pairs.items():
        part = facts[fact_col] == right[keys[dim_col]]
        condition = part if condition is None else condition & part
    joined = facts.join(right, condition, "left").drop(*keys.values())
    if not defaults:
        return joined
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def spread_key(key: Column, by: Sequence[Column], sentinels: Sequence[int] = ()) -> Column:
    """A whole-number key whose null and sentinel values never match, and spread out.

    Such rows would all meet in one partition of a shuffled join. They get a
    large negative key from a hash of other columns instead: the same one in
    every attempt of a task.
    """
    none = key.isNull() if not sentinels else key.isNull() | key.isin(*sentinels)
    return F.when(none, -(F.lit(1 << 40) + F.pmod(F.xxhash64(*by), F.lit(1 << 40)))).otherwise(key.cast("long"))


def asked_rows(dim: DataFrame, dim_key: str, asked: DataFrame) -> DataFrame:
    """Rows of a dimension whose key is ``asked`` for in the one column of a frame, for lookups by wide facts.

    A dimension that can be broadcast is returned as it is. A larger one is
    cut to these rows and kept as a table, whose real size then decides.
    """
    if fits_broadcast(dim):
        return dim
    keys = asked.toDF("_asked").distinct()
    return scratch_table(dim.join(keys, F.col(dim_key) == F.col("_asked"), "left_semi"), "asked")


def packed_lookup(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    name: str,
    keep: Sequence[str],
    limit: int | None = None,
    spread_by: Sequence[str] = (),
    sentinels: Sequence[int] = (),
) -> DataFrame:
    """Left join that brings a dimension's columns as one struct column.

    In a long chain of lookups every join copies one field per role, not one
    per attribute; the attributes are unpacked once, at the end. Where the
    dimension outgrows a broadcast and ``spread_by`` names columns of the
    facts, null keys and ``sentinels``, which the dimension must not hold, are
    spread over all partitions.
    """
    right = dim.select(F.col(dim_key).alias("_pk"), F.struct(*keep).alias(name))
    if not spread_by or fits_broadcast(right, limit):
        right = broadcast_if_small(right, limit)
        return facts.join(right, facts[fact_key] == right["_pk"], "left").drop("_pk")
    left = facts.withColumn("_fk", spread_key(F.col(fact_key), [F.col(c) for c in spread_by], sentinels))
    right = right.withColumn("_pk", F.col("_pk").cast("long"))
    return left.join(right, left["_fk"] == right["_pk"], "left").drop("_pk", "_fk")


def effective_dated_join(
    facts: DataFrame,
    dim: DataFrame,
    key: Mapping[str, str],
    date,
    keep: Sequence[str],
    prefix: str = "",
    valid_from: str = "valid_from_date",
    valid_to: str = "valid_to_date",
    where: Column | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Left join to the dimension version that holds on a date.

    ``date`` is a run date (text) or a fact column. With a run date the
    dimension is cut to its current versions first, so the join itself is a
    plain equality. With a column see ``versions_on``.
    """
    ((fact_key, dim_key),) = key.items()
    source = dim if where is None else dim.where(where)
    if isinstance(date, str):
        current = valid_on(source, date, valid_from, valid_to)
        right = current.select(F.col(dim_key).alias("_dk"), *[F.col(c).alias(prefix + c) for c in keep])
        right = broadcast_if_small(right, limit)
        return facts.join(right, facts[fact_key] == right["_dk"], "left").drop("_dk")
    return versions_on(facts, source, fact_key, dim_key, date, keep, prefix, valid_from, valid_to)


def role_join(
    facts: DataFrame,
    dim: DataFrame,
    dim_key: str,
    roles: Mapping[str, str],
    keep: Sequence[str],
    date: str | None = None,
    limit: int | None = None,
    **validity: str,
) -> DataFrame:
    """Join one dimension several times; ``roles`` maps a prefix to a fact key."""
    current = dim if date is None else valid_on(dim, date, **validity)
    result = facts
    for i, (prefix, fact_key) in enumerate(roles.items()):
        right = current.select(F.col(dim_key).alias(f"_r{i}"), *[F.col(c).alias(prefix + c) for c in keep])
        right = broadcast_if_small(right, limit)
        result = result.join(right, result[fact_key] == right[f"_r{i}"], "left").drop(f"_r{i}")
    return result


def join_on_expression(
    facts: DataFrame, key: Column, dim: DataFrame, dim_key: str, keep: Sequence[str], how: str = "left"
) -> DataFrame:
    """Equality join on a computed key, materialised once on the fact side."""
    left = facts.withColumn("_ek", key)
    right = broadcast_if_small(dim.select(F.col(dim_key).alias("_dk"), *keep))
    return left.join(right, left["_ek"] == right["_dk"], how).drop("_ek", "_dk")


def fan_out(df: DataFrame, name: str, codes: Sequence[str], where: Column | None = None) -> DataFrame:
    """Copy each row once per code: a narrow explode, no join and no shuffle."""
    source = df if where is None else df.where(where)
    return source.drop(name).withColumn(name, F.explode(F.array(*[F.lit(c) for c in codes])))


def semi_join(df: DataFrame, other: DataFrame, on) -> DataFrame:
    return df.join(other, on, "left_semi")


def anti_join_null_safe(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a partner, with null keys comparing as equal."""
    right = other.select(*[F.col(k).alias(f"_n{i}") for i, k in enumerate(keys)])
    condition = None
    for i, k in enumerate(keys):
        part = df[k].eqNullSafe(right[f"_n{i}"])
        condition = part if condition is None else condition & part
    return df.join(right, condition, "left_anti")


def successor_map(
    dim: DataFrame,
    key: str,
    natural: Sequence[str],
    date: str,
    valid_from: str = "valid_from_date",
    valid_to: str = "valid_to_date",
) -> DataFrame:
    """For every key ever used: the key of the version that holds on a date.

    Versions are matched on their natural attributes, nulls comparing as
    equal. One row per old key, so using it never multiplies rows.
    """
    old = dim.select(F.col(key).alias("old_key"), *[F.col(c).alias(f"_o_{c}") for c in natural]).distinct()
    new = (
        valid_on(dim, date, valid_from, valid_to)
        .groupBy(*[F.col(c).alias(f"_n_{c}") for c in natural])
        .agg(F.min(key).alias("new_key"))
    )
    condition = None
    for c in natural:
        part = old[f"_o_{c}"].eqNullSafe(new[f"_n_{c}"])
        condition = part if condition is None else condition & part
    return old.join(new, condition, "left").groupBy("old_key").agg(F.min("new_key").alias("new_key"))


def rekey(
    facts: DataFrame,
    roles: Mapping[str, str],
    successors: DataFrame,
    default,
    limit: int | None = None,
) -> DataFrame:
    """Replace prior keys by current ones; ``roles`` maps key column to result column.

    The dimension is joined to itself once, in ``successor_map``; each role
    then costs one lookup instead of two joins.
    """
    result = facts
    right_side = broadcast_if_small(successors, limit)
    for i, (source, target) in enumerate(roles.items()):
        right = right_side.select(F.col("old_key").alias(f"_ok{i}"), F.col("new_key").alias(f"_nk{i}"))
        result = result.join(right, result[source] == right[f"_ok{i}"], "left")
        result = result.withColumn(target, F.coalesce(F.col(f"_nk{i}"), F.lit(default))).drop(f"_ok{i}", f"_nk{i}")
    return result


def scalar_lookup(
    df: DataFrame,
    keys: Mapping[str, str],
    dim: DataFrame,
    values: Mapping[str, str],
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """One value per row from many matches: the smallest, so it is repeatable.

    ``keys`` maps frame column to dimension column, ``values`` dimension
    column to result column. The dimension is reduced to one row per key first.
    """
    reduced = dim.groupBy(*dict.fromkeys(keys.values())).agg(*[F.min(c).alias(v) for c, v in values.items()])
    return lookup(df, reduced, keys, defaults)


def prior_period_join(
    current: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    period: str,
    previous_period: Column,
    values: Mapping[str, str],
) -> DataFrame:
    """Left join to the same key one period earlier; ``values`` renames what is taken.

    History is brought to one row per key first, each value the smallest, so
    a repeated row never multiplies the current ones.
    """
    left = current.withColumn("_pp", previous_period)
    right = history.groupBy(
        *[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)], F.col(period).alias("_hp")
    ).agg(*[F.min(c).alias(v) for c, v in values.items()])
    condition = left["_pp"] == right["_hp"]
    for i, k in enumerate(keys):
        condition = condition & (left[k] == right[f"_h{i}"])
    return left.join(right, condition, "left").drop("_pp", "_hp", *[f"_h{i}" for i in range(len(keys))])
