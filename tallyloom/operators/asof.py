"""As-of merge: the dimension version that holds on each row's own date.

A key may have very many versions, and one key may be that of a third of all
facts. So the facts do not meet the versions: what is asked, the distinct pairs
of key and day, is united with the versions and sorted once per key, and the
last version is carried on to the pairs behind it. A key then has as many rows
in one task as versions and days. The answers go back to the facts by an
equality on key and day, in which the facts can be split at any key.

Versions that hold on no day between the first and the last one asked of their
key are left out before anything is sorted.

Gaps: a pair behind the end of its version has none. Overlaps: of keys whose
versions overlap more than one may hold, so their versions are cut into blocks
of whole powers of two of days, aligned as a day's own blocks are. A day lies in
one block of each size, so a pair meets a version once if it holds and never if
it does not: an equality, whose rows are the answers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.sizing import broadcast_if_small


def with_overlaps(versions: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Keys of which a version starts before an earlier one has ended."""
    before = Window.partitionBy(key).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    marked = versions.select(key, (F.col(start) < F.max(end).over(before)).alias("_over"))
    return marked.where("_over").select(key).distinct()


def asked_spans(asked: DataFrame, versions: DataFrame) -> DataFrame:
    """Versions that hold on a day between the first and the last one asked of their key."""
    spans = asked.groupBy(F.col("_k").alias("_sk")).agg(F.min("_d").alias("_first"), F.max("_d").alias("_last"))
    met = (F.col("_k") == F.col("_sk")) & (F.col("_from") <= F.col("_last")) & (F.col("_to") > F.col("_first"))
    return versions.join(broadcast_if_small(spans), met, "left_semi")


def _day(date: str) -> Column:
    """Number of a day, positive for every date."""
    return F.unix_date(date).cast("long") + F.lit(1 << 31)


def day_blocks(versions: DataFrame) -> DataFrame:
    """Each version once for each aligned block of 2 ** ``_size`` days it is made of, ``_block`` being its number.

    From the start on, blocks grow while the next larger one is not aligned;
    from the end back likewise: at most two of a size, and fewer than twice the
    digits of the length of the version.
    """
    sized = versions.withColumn("_size", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.length(F.bin(F.datediff("_to", "_from"))) - 1))))
    # Whole blocks of this size inside the version, and of the next larger one.
    whole = {"_lo": "-shiftright(-_a, _size)", "_hi": "shiftright(_b, _size)", "_outer_lo": "-shiftright(-_a, _size + 1)", "_outer_hi": "shiftright(_b, _size + 1)"}
    sized = sized.withColumns({"_a": _day("_from"), "_b": _day("_to")}).withColumns({name: F.expr(text) for name, text in whole.items()}).where("_lo < _hi")
    # The first and the last one are taken unless the larger block they belong to lies inside as well.
    parts = sized.withColumn("_block", F.explode(F.array_distinct(F.array(F.col("_lo"), F.col("_hi") - 1))))
    return parts.where("NOT (shiftright(_block, 1) >= _outer_lo AND shiftright(_block, 1) < _outer_hi)").select("_k", "_size", "_block", "_from", "_to", "_version")


def answers(asked: DataFrame, versions: DataFrame, latest: bool = False) -> DataFrame:
    """(_k, _d, _version) for the pairs (_k, _d) that a version (_k, _from, _to, _version) holds for.

    A version holds from its start up to the day before its end. With
    ``latest`` the one that started last (then the one that ends last, then the
    largest) answers alone where several hold; otherwise each of them does.
    """
    holding = asked_spans(asked, versions.where(F.col("_k").isNotNull() & (F.col("_from") < F.col("_to"))))
    crossed = with_overlaps(holding, "_k", "_from", "_to")
    plain = holding.join(crossed, "_k", "left_anti")
    events = plain.select("_k", F.col("_from").alias("_d"), F.lit(0).alias("_kind"), F.struct("_to", "_version").alias("_held"))
    events = events.unionByName(asked.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    # A version that starts on the day asked for holds already.
    upto = Window.partitionBy("_k").orderBy("_d", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    carried = events.withColumn("_held", F.last("_held", ignorenulls=True).over(upto)).where((F.col("_kind") == 1) & (F.col("_held._to") > F.col("_d")))
    single = carried.select("_k", "_d", F.col("_held._version").alias("_version"))
    blocks = day_blocks(holding.join(crossed, "_k", "left_semi"))
    # Only sizes that the key's versions are made of are looked up.
    sizes = blocks.select("_k", "_size").distinct()
    places = asked.join(sizes, "_k").withColumn("_place", F.call_function("shiftright", _day("_d"), F.col("_size")))
    several = places.join(blocks.withColumnRenamed("_block", "_place"), ["_k", "_size", "_place"])
    if latest:
        top = F.max(F.struct("_from", "_to", "_version"))["_version"]
        several = several.groupBy("_k", "_d").agg(top.alias("_version"))
    return single.unionByName(several.select("_k", "_d", "_version"))


def versions_on(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    date: Column,
    keep: Sequence[str],
    prefix: str = "",
    valid_from: str = "valid_from_date",
    valid_to: str = "valid_to_date",
    latest: bool = False,
) -> DataFrame:
    """Left join of each fact to the version of its key that holds on ``date``, by the day.

    A row with a null key or date, or whose day falls into a gap, gets nulls.
    Where versions overlap, a row is repeated for each that holds, or with
    ``latest`` takes the one that started last.
    """
    left = facts.withColumn("_fk", F.col(fact_key)).withColumn("_fd", F.to_date(date))
    asked = left.where(F.col("_fk").isNotNull() & F.col("_fd").isNotNull()).select(F.col("_fk").alias("_k"), F.col("_fd").alias("_d")).distinct()
    versions = dim.select(
        F.col(dim_key).alias("_k"), F.to_date(valid_from).alias("_from"), F.to_date(valid_to).alias("_to"), F.struct(*keep).alias("_version")
    )
    found = answers(asked, versions, latest)
    joined = left.join(found, (left["_fk"] == found["_k"]) & (left["_fd"] == found["_d"]), "left")
    return joined.select(*[facts[c] for c in facts.columns], *[F.col(f"_version.{c}").alias(prefix + c) for c in keep])
