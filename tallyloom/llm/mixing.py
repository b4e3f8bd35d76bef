"""Mixing sources to target weights along a time-varying curriculum.

Sources, in code point order with null last, get the weights of ``WEIGHTS`` in
turn. Together they share ``share`` times all words; a target stops at
``repeats`` times the size of its source, and the excess is shared again by
weight until none is above.

The documents of a source form a stream, ordered by a digest of their id. The
stream is read up to the target, again from its begin where the target is
larger than the source, so a document is taken whole, in part (at most one per
source and reading) or not at all. When a word is needed follows from the
source's weight schedule over training time: the schedule is integrated, and
the inverse of the cumulative demand turns the place of a document in its
stream into its training position, by which documents are range-sorted.

No source is sorted in one task: streams are cut into ``SLICES`` slices by the
digest, sums of slices give each slice its begin, and only the words within one
slice are summed in order.

Defined results: a null or empty text has size 0 and is never taken; a null
source is a source of its own; documents with equal ids follow each other by
size; equal rows are taken in any order; a table without words has targets of
0; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.ordering import numbered, range_sorted, ranked
from tallyloom.operators.sizing import broadcast_if_small
from tallyloom.session import scratch_table

WEIGHTS = (5, 2, 1)
SHARE, REPEATS = 1.5, 2
SLICES = 4096
# Knots (time, weight) of each weight class: heavy sources lead, light ones close.
SCHEDULES: Mapping[int, Sequence[tuple[float, float]]] = {
    5: ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    2: ((0.0, 1.0), (1.0, 1.0)),
    1: ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
}
WORD = r"[^\x20\x09-\x0D]+"


def sizes(documents: DataFrame) -> DataFrame:
    """(doc_id, source, size, stream, order, slice) of every document.

    ``stream`` names the source in a column that is never null.
    """
    order = F.coalesce(F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit(""))
    return documents.select(
        "doc_id",
        "source",
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("stream"),
        order.alias("order"),
        (F.pmod(F.coalesce(F.conv(F.substring(order, 1, 6), 16, 10).cast("int"), F.lit(0)) / (1 << 12), F.lit(SLICES)).cast("int")).alias("slice"),
    )


def targets(sized: DataFrame, share: float = SHARE, repeats: int = REPEATS, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """(stream, source_size, weight, target): one row per source.

    Sources that are full are those with the smallest size for their weight:
    going through them in that order, a source is full if its share of what is
    then left would be above its limit. The windows hold one row per source.
    """
    totals = sized.groupBy("stream", "source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), turn.cast("int") + 1)
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), "stream")
    before, after = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pool = F.sum("source_size").over(whole) * F.lit(share)
    filled = totals.withColumn("weight", weight).select(
        "*",
        pool.alias("pool"),
        (pool - F.coalesce(F.sum(F.col("source_size") * repeats).over(before), F.lit(0))).alias("rest"),
        F.sum("weight").over(after).alias("sharing"),
    )
    full = F.col("weight") * F.col("rest") > F.col("source_size") * repeats * F.col("sharing")
    split = filled.withColumn("full", full).select(
        "*",
        (F.col("pool") - F.coalesce(F.sum(F.when(F.col("full"), F.col("source_size") * repeats)).over(whole), F.lit(0))).alias("left"),
        F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole).alias("open"),
    )
    limit = (F.col("source_size") * repeats).cast("double")
    return split.select(
        "stream", "source_size", "weight", F.when(F.col("full"), limit).otherwise(F.col("left") * F.col("weight") / F.col("open")).alias("target")
    )


def position(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Time at which a schedule has used up a share (0 to 1) of its integral.

    Between two knots the weight is linear and its integral quadratic.
    """
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    used = share * F.lit(float(sum(areas)))
    out, before = F.lit(float(knots[-1][0])), sum(areas)
    for ((t0, w0), (t1, w1)), area in reversed(list(zip(zip(knots, knots[1:]), areas))):
        before -= area
        rest, slope = F.greatest(used - before, F.lit(0.0)), (w1 - w0) / (t1 - t0)
        # rest = w0 x + slope x^2 / 2, solved in the form that is stable for any slope
        x = 2 * rest / (F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * rest, F.lit(0.0))))
        out = F.when(used < before + area, F.lit(t0) + x).otherwise(out)
    return out


def mix(documents: DataFrame, share: float = SHARE, repeats: int = REPEATS, schedules: Mapping[int, Sequence[tuple[float, float]]] = SCHEDULES) -> DataFrame:
    """One row per document: size, source_size, target, taken, and its draws.

    ``draws`` lists (reading, take, position) of every time it is read;
    ``taken`` is the sum of what they take.
    """
    sized = scratch_table(sizes(documents), "sized")
    aims = scratch_table(targets(sized, share, repeats), "targets")
    slices = sized.groupBy("stream", "slice").agg(F.sum("size").alias("words"))
    # One row per slice: at most SLICES for each source.
    begins = slices.select(
        "stream", "slice",
        (F.sum("words").over(Window.partitionBy("stream").orderBy("slice")) - F.col("words")).alias("begin"),
    )
    within = Window.partitionBy("stream", "slice").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        sized.withColumn("offset", F.sum("size").over(within) - F.col("size"))
        # Both sides are dealt by stream and slice already.
        .join(scratch_table(begins, "begins"), ["stream", "slice"])
        .join(broadcast_if_small(aims), "stream")
        .withColumn("first", F.col("begin") + F.col("offset"))
        .withColumn("goal", F.floor(F.col("target") + 0.5))
    )

    def draw(reading):
        start = F.col("first") + reading * F.col("source_size")
        take = F.greatest(F.least(F.col("goal") - start, F.col("size")), F.lit(0))
        used = start / F.col("target")
        time = F.lit(None).cast("double")
        for weight, knots in schedules.items():
            time = F.when(F.col("weight") == weight, position(used, knots)).otherwise(time)
        return F.struct(F.lit(reading).alias("reading"), take.alias("take"), F.when(take > 0, time).alias("position"))

    draws = F.filter(F.array(*(draw(n) for n in range(repeats))), lambda d: d["take"] > 0)
    taken = sum((F.greatest(F.least(F.col("goal") - F.col("first") - n * F.col("source_size"), F.col("size")), F.lit(0)) for n in range(repeats)), F.lit(0))
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), draws.alias("draws"))


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per draw, range-sorted by training position."""
    drawn = mixed.select("doc_id", "source", "size", F.explode("draws").alias("d"))
    return drawn.select("doc_id", "source", "size", "d.*").orderBy("position", "source", "doc_id", "reading")


def ranked_documents(mixed: DataFrame) -> DataFrame:
    """``mix`` with the position of each document's first reading and its rank (from 1) among all readings.

    Readings are range-sorted by position; only one row per sorted part says
    where its ranks begin. Both are null for a document that is not taken.
    """
    rows = numbered(mixed, "mixed")
    drawn = rows.select("row", "doc_id", "source", F.explode("draws").alias("d")).select("row", "doc_id", "source", "d.reading", "d.position")
    order = [F.col(c).asc_nulls_first() for c in ("position", "source", "doc_id", "reading", "row")]
    ranks = ranked(range_sorted(drawn, order, "readings"))
    first = ranks.groupBy("row").agg(F.min(F.struct((F.col("rank") + 1).alias("rank"), "position")).alias("first"))
    return rows.join(first, "row", "left").select(*mixed.columns, F.col("first.position").alias("first_position"), F.col("first.rank").alias("training_rank"))
