"""Exact duplicates: fuse filters over stored snapshots, byte checks on hits.

A snapshot is an immutable set of documents that an earlier batch left: their
digests in buckets, and one static binary fuse filter per bucket. A new batch
is grouped by digest within itself; the distinct digests are screened by the
filters of their bucket, and only what passes is joined with the snapshot's
digests and compared byte by byte. What no filter knows never meets the
snapshot.

Defined results: a null text counts as empty; empty texts are equal to each
other; of rows with equal text and equal id the longest stays, but all of them
say that they stay, since an id does not tell them apart; a row
without an id stays only where no row of its group has one; an empty table
gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.sizing import broadcast_if_small
from tallyloom.session import scratch_table

# Characters that two equal texts may differ in: [\x20\x09-\x0D].
IGNORED = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
# Distinct digests one filter holds at most on average.
KEYS_PER_BUCKET = 1 << 14


def apart(columns: Sequence[str], *names: str) -> list[str]:
    """The names, lengthened until none is among the columns."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def normalised(text: Column) -> Column:
    """The text without the ignored characters; null gives an empty text."""
    out = F.coalesce(text, F.lit(""))
    for character in IGNORED:
        out = F.replace(out, F.lit(character), F.lit(""))
    return out


def digests(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_points, digest): one row per document, without its text."""
    text = F.col(text_column)
    return documents.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.length(text), F.lit(0)).cast("long").alias("n_points"),
        F.sha2(normalised(text).cast("binary"), 256).alias("digest"),
    )


def _rank() -> Column:
    """Greatest for the row that stays: one with an id, the longest, the smallest id."""
    return F.struct(F.col("doc_id").isNotNull().alias("named"), "n_points", F.bitwise_not(F.col("doc_id").cast("long")).alias("order"), "doc_id")


def groups(rows: DataFrame) -> DataFrame:
    """One row per digest: which document stays, how many there are.

    Two sums over partial rows: the longest text of each digest, then the
    smallest id at that length; no group is gathered.
    """
    by_length = rows.groupBy("digest", "n_points").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("rows")
    )
    return by_length.groupBy("digest").agg(
        F.max(_rank()).alias("best"),
        F.sum("rows").alias("rows"),
    ).select("digest", F.col("best.doc_id").alias("doc_id"), F.col("best.n_points").alias("n_points"), "rows")


def bucket_of(digest: Column, buckets: int) -> Column:
    """Exact bucket of a hex digest, from its first 28 bits."""
    return F.pmod(F.conv(F.substring(digest, 1, 7), 16, 10).cast("int"), F.lit(buckets))


def digest_keys(digest: Column) -> Column:
    """64 bits of a digest as the key a filter holds."""
    return F.xxhash64(digest)


# --- the filter --------------------------------------------------------------


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _shape(n: int) -> tuple[int, int]:
    """(segment length, number of slots) for n keys and three hashes."""
    segment = 1 << max(2, min(18, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25))))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 3)))
    count = max(1, int(np.ceil(n * factor / segment)) - 2)
    return segment, (count + 2) * segment


def _slots(mixed: np.ndarray, segment: int, slots: int) -> np.ndarray:
    """Three slots of each key, in three neighbouring segments."""
    starts = slots - 2 * segment
    first = ((mixed >> np.uint64(32)) * np.uint64(starts)) >> np.uint64(32)
    mask = np.uint64(segment - 1)
    second = (first + np.uint64(segment)) ^ ((mixed >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (mixed & mask)
    return np.stack([first, second, third]).astype(np.int64)


def _prints(mixed: np.ndarray) -> np.ndarray:
    return ((mixed ^ (mixed >> np.uint64(32))) & np.uint64(0xFFFF)).astype(np.uint16)


def build_filter(keys: np.ndarray) -> tuple[int, int, bytes]:
    """(seed, segment length, 16-bit fingerprints) of a set of 64-bit keys.

    Keys are peeled in rounds: each round takes every slot that a single key
    still uses; fingerprints are then set in the reverse order.
    """
    keys = np.unique(keys.astype(np.uint64))
    segment, slots = _shape(len(keys))
    for seed in range(1000):
        mixed = _mix(keys, seed)
        where = _slots(mixed, segment, slots)
        count = np.bincount(where.ravel(), minlength=slots)
        owners = np.zeros(slots, dtype=np.int64)
        index = np.arange(len(keys))
        for row in where:
            np.bitwise_xor.at(owners, row, index)
        left, order = np.ones(len(keys), dtype=bool), []
        while True:
            single = np.flatnonzero(count == 1)
            if not len(single):
                break
            key, at = np.unique(owners[single], return_index=True)
            order.append((key, single[at]))
            left[key] = False
            for row in where[:, key]:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(owners, row, key)
        if left.any():
            continue
        table, prints = np.zeros(slots, dtype=np.uint16), _prints(mixed)
        for key, slot in reversed(order):
            table[slot] = 0
            table[slot] = prints[key] ^ np.bitwise_xor.reduce(table[where[:, key]], axis=0)
        return seed, segment, table.tobytes()
    raise ValueError("no seed gives a filter; the keys are not distinct")


def may_contain(keys: np.ndarray, seed: int, segment: int, table: bytes) -> np.ndarray:
    """True for every key of the set, and for about one in 65536 others."""
    slots = np.frombuffer(table, dtype=np.uint16)
    mixed = _mix(keys.astype(np.uint64), seed)
    found = np.bitwise_xor.reduce(slots[_slots(mixed, segment, len(slots))], axis=0)
    return found == _prints(mixed)


# --- snapshots ---------------------------------------------------------------

FILTER_SCHEMA = "bucket int, seed int, segment int, fingerprints binary"


def _filters(bucket, table):
    keys = table["key"].to_numpy().view(np.uint64)
    seed, segment, prints = build_filter(keys)
    return pa.table(
        {
            "bucket": pa.array([bucket[0].as_py()], pa.int32()),
            "seed": pa.array([seed], pa.int32()),
            "segment": pa.array([segment], pa.int32()),
            "fingerprints": pa.array([prints], pa.binary()),
        }
    )


class Snapshot:
    """Immutable: distinct digests with the document that stays, and filters."""

    def __init__(self, entries: DataFrame, filters: DataFrame, buckets: int):
        self.entries, self.filters, self.buckets = entries, filters, buckets

    @staticmethod
    def write(rows: DataFrame) -> Snapshot:
        """Group the digests of a batch and store them with their filters."""
        found = scratch_table(groups(rows), "snapshot")
        buckets = max(1, -(-found.count() // KEYS_PER_BUCKET))
        entries = found.withColumn("bucket", bucket_of(F.col("digest"), buckets))
        filters = (
            entries.select("bucket", digest_keys(F.col("digest")).alias("key"))
            .groupBy("bucket")
            .applyInArrow(_filters, FILTER_SCHEMA)
        )
        return Snapshot(entries, scratch_table(filters, "filters"), buckets)


def _screen(bucket, incoming, filters):
    if not filters.num_rows or not incoming.num_rows:
        return incoming.slice(0, 0).select(["digest"])
    row = filters.slice(0, 1).to_pylist()[0]
    keys = incoming["key"].to_numpy().view(np.uint64)
    return incoming.select(["digest"]).filter(
        pa.array(may_contain(keys, row["seed"], row["segment"], row["fingerprints"]))
    )


def screen(found: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Digests of a batch that the snapshot's filters let through.

    A bucket is a fixed share of the digests by their own bits, so no text,
    however often it is repeated, makes one bucket larger than another.
    """
    keyed = found.select("digest", bucket_of(F.col("digest"), snapshot.buckets).alias("bucket"), digest_keys(F.col("digest")).alias("key"))
    return (
        keyed.groupBy("bucket").cogroup(snapshot.filters.groupBy("bucket")).applyInArrow(_screen, "digest string")
    )


def same_bytes(pairs: DataFrame, documents: DataFrame, stored: DataFrame) -> DataFrame:
    """Digests of the pairs (digest, doc_id, stored_id) whose normalised texts are the same bytes.

    A row is found by its digest and its id, null or not; one text of equal
    digest and id stands for all of them.
    """

    def texts(rows: DataFrame, id_column: str, name: str) -> DataFrame:
        about = rows.select(F.col("doc_id").alias("own_id"), normalised(F.col("text")).alias(name))
        about = about.withColumn("own_digest", F.sha2(F.col(name).cast("binary"), 256))
        wanted = pairs.select("digest", F.col(id_column).alias("wanted_id"))
        found = about.join(
            broadcast_if_small(wanted), (F.col("own_digest") == F.col("digest")) & F.col("own_id").eqNullSafe(F.col("wanted_id"))
        )
        return found.groupBy("digest").agg(F.first(name).alias(name))

    both = texts(documents, "doc_id", "text").join(texts(stored, "stored_id", "stored_text"), "digest")
    return both.where(F.col("text") == F.col("stored_text")).select("digest")


def exact_dedup(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Group a batch within itself and against a stored snapshot.

    Both need doc_id and text. Returns one row per document of either:
    doc_id, keep_id, group_size, kept, text_sha256, and in_snapshot. Of equal
    texts one with an id stays, then the one with the most code points, then the
    smallest id.
    """
    stored, batch = stored.select("doc_id", "text"), batch.select("doc_id", "text")
    rows = scratch_table(
        digests(stored).withColumn("in_snapshot", F.lit(True)).unionByName(
            digests(batch).withColumn("in_snapshot", F.lit(False))
        ),
        "digests",
    )
    snapshot = Snapshot.write(rows.where("in_snapshot").drop("in_snapshot"))
    fresh = scratch_table(groups(rows.where("NOT in_snapshot")), "batch")
    hits = screen(fresh, snapshot)
    pairs = scratch_table(
        fresh.join(hits, "digest", "left_semi").select("digest", "doc_id").join(
            snapshot.entries.select("digest", F.col("doc_id").alias("stored_id")), "digest"
        ),
        "pairs",
    )
    equal = same_bytes(pairs, batch, stored)
    # Equal digests with unequal bytes stay two groups.
    unequal = pairs.select("digest").join(equal, "digest", "left_anti").withColumn("apart", F.lit(True))
    unequal = scratch_table(unequal, "unequal")
    both = (
        snapshot.entries.select("digest", "doc_id", "n_points", "rows", F.lit(True).alias("in_snapshot"))
        .unionByName(fresh.select("digest", "doc_id", "n_points", "rows", F.lit(False).alias("in_snapshot")))
        .join(broadcast_if_small(unequal), "digest", "left")
        .withColumn("side", F.when(F.col("apart"), F.col("in_snapshot")))
    )
    merged = (
        both.groupBy("digest", "side")
        .agg(
            F.max(_rank()).alias("best"),
            F.sum("rows").alias("group_size"),
        )
        .where("group_size > 1")
        .select("digest", "side", F.col("best.doc_id").alias("keep_id"), "group_size")
    )
    several = scratch_table(merged, "groups")
    joined = rows.alias("r").join(
        several.alias("g"),
        (F.col("r.digest") == F.col("g.digest")) & (F.col("g.side").isNull() | (F.col("g.side") == F.col("r.in_snapshot"))),
        "left",
    )
    return joined.select(
        F.col("r.doc_id").alias("doc_id"),
        F.coalesce("g.keep_id", "r.doc_id").alias("keep_id"),
        F.coalesce("g.group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce("g.keep_id", "r.doc_id").eqNullSafe(F.col("r.doc_id")).alias("kept"),
        F.col("r.digest").alias("text_sha256"),
        F.col("r.in_snapshot").alias("in_snapshot"),
    )


def in_two_batches(documents: DataFrame) -> DataFrame:
    """Exact duplicates of one table: half of its ids stored first, then the rest.

    The result does not depend on which half a row is in.
    """
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    return exact_dedup(documents.where(half == 1), documents.where(half == 0))


def kept_documents(documents: DataFrame) -> DataFrame:
    """The rows, whole, that stay; of rows with equal id and equal text, the longest, once.

    A row is decided by its id, null or not, and the digest of its text.
    """
    row_id, sha, digest, longest_ = apart(documents.columns, "_id", "_sha", "_digest", "_longest")
    found = in_two_batches(documents).where("group_size > 1").select(F.col("doc_id").alias(row_id), F.col("text_sha256").alias(sha), "kept")
    found = scratch_table(found, "decided")
    dropped = found.where("NOT kept").select(row_id, sha).distinct()
    repeated = found.where("kept").groupBy(row_id, sha).count().where("count > 1").select(row_id, sha)
    repeated = scratch_table(repeated, "repeated")
    keyed = documents.withColumn(digest, F.sha2(normalised(F.col("text")).cast("binary"), 256))
    same = F.col("doc_id").eqNullSafe(F.col(row_id)) & (F.col(digest) == F.col(sha))
    rest = keyed.join(broadcast_if_small(dropped), same, "left_anti")
    length = F.coalesce(F.length("text"), F.lit(0))
    again = rest.join(broadcast_if_small(repeated), same)
    longest = again.groupBy(row_id, sha).agg(F.max(length).alias(longest_))
    once = rest.join(longest, same).where(length == F.col(longest_)).dropDuplicates(["doc_id", digest])
    whole = rest.join(broadcast_if_small(repeated), same, "left_anti")
    return whole.select(*documents.columns).unionByName(once.select(*documents.columns))
