"""Band joins: a value to the bands that hold it, through a sorted interval index.

The bounds of all bands, sorted, cut the line into places: place 2i - 1 is the
i-th bound itself, place 2i what lies between it and the next one. A band holds
a run of places, with or without the two on its bounds. A value finds its place
by halving the list of bounds, and the join is an equality on the place.

That index is one array, so it serves lists of checked size. A longer list is
cut into segments of about ``BANDS_PER_SEGMENT`` bands, at quantiles of its own
bounds; a value falls into one segment and is compared with the bands there.
A segment that many values share (the default that stands for a missing value
is one) is salted by its measured number of values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.sizing import broadcast_if_small, planned_bytes

# A list of bands above this planned size, or with more bounds, is not indexed as one array.
INDEX_LIMIT_BYTES, MOST_CUTS = 4 * 1024 * 1024, 1 << 16
BANDS_PER_SEGMENT, MOST_SEGMENTS = 64, 1 << 14
# Salted groups for each shuffle partition, so that hashing deals them evenly.
GROUPS_PER_PARTITION = 32


def in_band(value: Column, lower: Column, upper: Column, lower_inclusive: Column, upper_inclusive: Column) -> Column:
    """Strictly inside the bounds, or on a bound flagged inclusive."""
    return (
        ((value > lower) & (value < upper))
        | ((value == lower) & (lower_inclusive == "Y"))
        | ((value == upper) & (upper_inclusive == "Y"))
    )


def not_above(cuts: Column, value: Column, most: int) -> Column:
    """How many of at most ``most`` sorted cuts are not above a value, found by halving."""
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, most.bit_length())))])
    # Behind the end of the list ``get`` is null, which counts as above.
    return F.aggregate(halves, F.lit(0), lambda at, half: F.when(F.get(cuts, at + half - 1) <= value, at + half).otherwise(at))


def place(cuts: Column, value: Column, most: int) -> Column:
    """Place of a value among sorted cuts: odd on a cut, even between two."""
    at = not_above(cuts, value, most)
    return F.transform(F.array(at), lambda n: 2 * n - F.when(F.get(cuts, n - 1) == value, 1).otherwise(0))[0]


def _places(cuts: Column, most: int) -> Column:
    """All places that a band (_lo, _hi, _li, _ui) holds."""
    none = F.array().cast("array<int>")
    low, high = (2 * not_above(cuts, F.col(c), most) for c in ("_lo", "_hi"))
    inside = F.when(F.col("_lo") < F.col("_hi"), F.sequence(low, high - 2))
    on_low = F.when((F.col("_li") == "Y") & F.col("_lo").isNotNull(), F.array(low - 1))
    on_high = F.when((F.col("_ui") == "Y") & F.col("_hi").isNotNull(), F.array(high - 1))
    return F.array_distinct(F.concat(*[F.coalesce(part, none) for part in (inside, on_low, on_high)]))


def _bounds(bands: DataFrame) -> list[float] | None:
    """The sorted bounds of a list of checked size, or None where they are too many after all."""
    found = bands.select(F.explode(F.array("_lo", "_hi")).alias("c")).where("c IS NOT NULL").distinct().take(MOST_CUTS + 1)
    return None if len(found) > MOST_CUTS else sorted({r.c for r in found})


def _indexed(left: DataFrame, bands: DataFrame, bounds: list[float]) -> DataFrame:
    """Equality join on the place; the bounds are one array."""
    cuts, most = F.lit(bounds) if bounds else F.array().cast("array<double>"), max(1, len(bounds))
    placed = bands.withColumn("_bp", F.explode(_places(cuts, most))).drop("_lo", "_hi", "_li", "_ui")
    left = left.withColumn("_vp", F.when(F.col("_v").isNotNull(), place(cuts, F.col("_v"), most)))
    return left.join(broadcast_if_small(placed), F.col("_vp") == F.col("_bp"), "left").drop("_v", "_vp", "_bp")


def segment_cuts(bands: DataFrame, segments: int) -> list[float]:
    """Bounds that cut a list of bands into about so many segments with equally many bounds."""
    bounds = bands.select(F.explode(F.array("_lo", "_hi")).alias("c")).where("c IS NOT NULL AND NOT isnan(c)")
    shares = [i / segments for i in range(1, segments)]
    return sorted(set(bounds.approxQuantile("c", shares, 1 / (4 * segments)))) if shares else []


def _segmented(left: DataFrame, bands: DataFrame, segments: int | None) -> DataFrame:
    """Equality join on segment and salt, with the bounds as a condition."""
    spark, columns = left.sparkSession, left.columns
    segments = segments or min(MOST_SEGMENTS, max(1, -(-bands.count() // BANDS_PER_SEGMENT)))
    cuts = segment_cuts(bands, segments)
    cut_array = F.lit(cuts) if cuts else F.array().cast("array<double>")

    def segment_of(c: Column) -> Column:
        return not_above(cut_array, c, max(1, len(cuts)))

    spread = F.xxhash64(*columns)
    # A value that is null matches no band; such rows are spread over segments without one.
    left = left.withColumn("_seg", F.coalesce(segment_of(F.col("_v")), F.lit(0))).withColumn(
        "_seg", F.when(F.col("_v").isNull(), -1 - F.pmod(spread, F.lit(1 << 20)).cast("int")).otherwise(F.col("_seg"))
    )
    held = left.where("_seg >= 0").groupBy("_seg").agg(F.count(F.lit(1)).alias("_n"))
    groups = GROUPS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = F.greatest(F.lit(1), F.ceil(F.sum("_n").over(Window.partitionBy()) / groups))
    # One row per segment, of which there are at most ``MOST_SEGMENTS`` + 1.
    salts = held.select("_seg", F.ceil(F.col("_n") / target).cast("int").alias("_salts"))
    left = left.join(F.broadcast(salts), "_seg", "left").withColumn("_salt", F.pmod(spread, F.coalesce("_salts", F.lit(1))).cast("int"))
    # A bound that is missing leaves only the other one.
    low, high = F.coalesce(F.least("_lo", "_hi"), "_lo", "_hi"), F.coalesce(F.greatest("_lo", "_hi"), "_lo", "_hi")
    right = bands.withColumn("_bseg", F.explode(F.sequence(segment_of(low), segment_of(high))))
    right = right.join(F.broadcast(salts.withColumnRenamed("_seg", "_bseg")), "_bseg").withColumn("_bsalt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    on = (F.col("_seg") == F.col("_bseg")) & (F.col("_salt") == F.col("_bsalt"))
    on = on & in_band(F.col("_v"), F.col("_lo"), F.col("_hi"), F.col("_li"), F.col("_ui"))
    return left.join(right, on, "left").drop("_v", "_seg", "_salts", "_salt", "_lo", "_hi", "_li", "_ui", "_bseg", "_bsalt")


def band_join(
    facts: DataFrame,
    bands: DataFrame,
    value: str,
    keep: Sequence[str],
    default: float | None = None,
    lower: str = "lower_value",
    upper: str = "upper_value",
    lower_inclusive: str = "lower_val_inclusive",
    upper_inclusive: str = "upper_val_inclusive",
    limit: int | None = None,
    segments: int | None = None,
) -> DataFrame:
    """Left join of a value to every band that holds it; both ways give the same rows.

    ``default`` stands for a missing value. A band with a null bound holds its
    other bound at most. ``limit`` is the planned size up to which the list is
    indexed as one array, ``segments`` sets the number of segments beyond it.
    """
    v = F.col(value).cast("double")
    left = facts.withColumn("_v", v if default is None else F.coalesce(v, F.lit(float(default))))
    right = bands.select(
        F.col(lower).cast("double").alias("_lo"),
        F.col(upper).cast("double").alias("_hi"),
        F.col(lower_inclusive).alias("_li"),
        F.col(upper_inclusive).alias("_ui"),
        *keep,
    )
    small = planned_bytes(right) <= (INDEX_LIMIT_BYTES if limit is None else limit)
    bounds = _bounds(right) if small else None
    if bounds is not None:
        return _indexed(left, right, bounds)
    return _segmented(left, right, segments)
