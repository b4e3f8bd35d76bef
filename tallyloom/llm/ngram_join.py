"""N-gram Jaccard join: universe partition, pigeonhole, exact verification.

Two shingle sets of sizes a and b with a similarity of at least 3/4 differ in
at most (a + b) / 7 shingles. Sizes are cut into bands (powers of two). Each
band has a scheme: the universe of shingles is hashed into m segments, and a
set falls into one subset per segment. A scheme serves pairs within its band
and pairs of its band with the next one.

Allocation. Every segment of a scheme gets a value: -1 (not indexed), 0 (its
subset is indexed) or 1 (its subset and its one-deletion neighbours are). If
the values + 1 of the segments that two sets index sum up to more than they
may differ in, one of these segments differs by no more than its value, and the
two sets meet at a signature. The values are chosen by cost, from how often
the subsets of a segment meet over all documents: segments that meet too often
are left out as long as the rest suffices, and further ones where raising
others to 1 costs less than their meetings.

Signatures. They are grouped in buckets by their own bits. A signature that
more than ``LONG_RUN`` sets share (or many within one batch) is hot: its sets
are linked to the smallest of them only, and it no longer counts for the
sum above. Any other run of sets is kept as a list.

What is verified, first by sizes and parity sketches (a lower bound of the
difference), then by the sets: pairs of every set with the smallest of its runs; then, when
these links have been joined to components, pairs of a list that are still in
different components. Sets whose remaining values do not suffice (short, or
made of common passages) are joined among themselves by their rarest shingles,
with frequencies counted over components. So no link between different
components is lost, and copies are never expanded into all pairs.

Defined results: null and empty texts have no shingles and are linked with
nothing; a row without an id is linked with nothing and reported with a null
component; rows that share an id are one node with the links of all of them,
each reported with the size of its own set; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.components import components
from tallyloom.llm.shingles import mix64, pieces, shingle_sets, small_batches
from tallyloom.operators.sizing import broadcast_if_small
from tallyloom.session import scratch_table

# Similarity of at least NUMERATOR / DENOMINATOR.
NUMERATOR, DENOMINATOR = 3, 4
SEGMENTS_PER_SHINGLE = 0.5
# Allocation is by cost up to this band; beyond it all values are 0.
COSTED_BANDS = 14
MEETING_COST = 8.0
SPARE = 1.04
LONG_RUN = 16
HOT_IN_BATCH = 8
# Rounds of links to drawn centres before all pairs of what is still apart.
CENTRE_ROUNDS = 2
SIGNATURES_PER_BUCKET = 1 << 20
# Characters whose signatures, or packed sets, are built together.
SIGNED_CHARACTERS, PACKED_CHARACTERS = 1_000_000, 500_000


def allowed(a: int, b: int) -> int:
    """Most shingles in which linked sets of these sizes can differ."""
    return (DENOMINATOR - NUMERATOR) * (a + b) // (DENOMINATOR + NUMERATOR)


def largest_partner(n: int) -> int:
    return n * DENOMINATOR // NUMERATOR


@dataclass(frozen=True)
class Scheme:
    """Segments of one band; ``values`` is None where all are 0."""

    band: int
    values: np.ndarray | None = None

    @property
    def upper(self) -> int:
        return 2 ** (self.band + 1) - 1

    @property
    def differ(self) -> int:
        return allowed(self.upper, largest_partner(self.upper))

    @property
    def segments(self) -> int:
        return max(self.differ + 1, int(np.ceil(SEGMENTS_PER_SHINGLE * (self.upper + 1))))


def roles(sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(sets, their scheme, shingles they may differ in) in their own band and in the one below."""
    some = np.flatnonzero(sizes > 0)
    n = sizes[some]
    band = np.floor(np.log2(n)).astype(np.int64)
    own = (some, band, (DENOMINATOR - NUMERATOR) * (n + n * DENOMINATOR // NUMERATOR) // (DENOMINATOR + NUMERATOR))
    below = (np.int64(1) << band) - 1
    reach = (band > 0) & (n <= below * DENOMINATOR // NUMERATOR)
    under = (some[reach], band[reach] - 1, (DENOMINATOR - NUMERATOR) * (n + below)[reach] // (DENOMINATOR + NUMERATOR))
    return [own, under]


def segment_counts(bands: np.ndarray) -> np.ndarray:
    """Number of segments of each scheme."""
    table = np.array([Scheme(k).segments for k in range(int(bands.max(initial=0)) + 1)], dtype=np.int64)
    return table[bands]


def subsets(shingles: np.ndarray, sizes: np.ndarray, members: np.ndarray, bands: np.ndarray):
    """Subsets of the given sets in the segments of the given schemes.

    Returns (set, band, segment, signature, size) for each subset that is not
    empty, and (subset, signature without it) for each shingle.
    """
    starts = np.cumsum(sizes) - sizes
    lengths = sizes[members]
    which = np.repeat(np.arange(len(members)), lengths)
    at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts[members], lengths)
    token, band = shingles[at], bands[which]
    segment = ((mix64(token ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)) * segment_counts(band).astype(np.uint64)) >> np.uint64(32)
    order = np.lexsort((segment, which))
    which, token, segment, band = which[order], token[order], segment[order].astype(np.int64), band[order]
    first = np.ones(len(which), dtype=bool)
    first[1:] = (which[1:] != which[:-1]) | (segment[1:] != segment[:-1])
    begin = np.flatnonzero(first)
    spread = mix64(token)
    total = np.add.reduceat(spread, begin) if len(begin) else np.zeros(0, dtype=np.uint64)
    count = np.diff(np.append(begin, len(which)))
    # Equal subsets of different segments or schemes must not meet.
    salt = mix64((band[begin].astype(np.uint64) << np.uint64(40)) + segment[begin].astype(np.uint64) + np.uint64(1))
    subset = np.repeat(np.arange(len(begin)), count)
    without = mix64(total[subset] - spread + salt[subset])
    return which[begin], band[begin], segment[begin], mix64(total + salt), count, subset, without


# --- allocation ---------------------------------------------------------------

# Stands for all segments of all schemes.
WHOLE = -1


def _measured(piece):
    """(key of scheme and segment, signature, size) of all subsets of a piece, and the number of shingles; built in parts."""
    found, total = {0: [], 1: []}, 0
    for part in pieces(piece, limit=SIGNED_CHARACTERS):
        shingles, sizes = shingle_sets(part["text"])
        total += len(shingles)
        for turn, (members, bands, _) in enumerate(roles(sizes)):
            keep = bands < COSTED_BANDS
            _, band, segment, signature, count, _, _ = subsets(shingles, sizes, members[keep], bands[keep])
            found[turn].append((band * (1 << 32) + segment, signature, count))
    return [[np.concatenate(column) for column in zip(*rows)] for rows in found.values()], total


def _measure(batches):
    """Per scheme and segment: subsets seen, how many met another in their piece, shingles."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for piece in pieces(batch):
            subsets_of, shingles = _measured(piece)
            sums.setdefault((WHOLE, WHOLE), np.zeros(3))[0] += shingles
            for key, signature, count in subsets_of:
                if not len(key):
                    continue
                _, back, often = np.unique(signature, return_inverse=True, return_counts=True)
                keys, inverse = np.unique(key, return_inverse=True)
                met = np.bincount(inverse, weights=(often[back] - 1).astype(float) / often[back])
                seen, held = np.bincount(inverse), np.bincount(inverse, weights=count)
                for k, s, m, h in zip(keys.tolist(), seen, met, held):
                    at = sums.setdefault((k >> 32, k & 0xFFFFFFFF), np.zeros(3))
                    at += (s, m, h)
            pa.default_memory_pool().release_unused()
    rows = [(b, g, *v) for (b, g), v in sums.items()]
    columns = list(zip(*rows)) if rows else [()] * 5
    yield pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), *(pa.array(c, pa.float64()) for c in columns[2:])],
        names=["band", "segment", "seen", "met", "held"],
    )


def allocate(scheme: Scheme, seen: np.ndarray, met: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Values of the segments of a scheme, by cost.

    They are to suffice for the largest sets of the band, which need most of
    them; whether they do is tested for each set.
    """
    values = np.zeros(scheme.segments, dtype=np.int8)
    filled = np.full(scheme.segments, 1 - np.exp(-scheme.upper / scheme.segments))
    share = met / np.maximum(seen, 1)
    need = SPARE * (scheme.differ + 1) + 2
    have = filled.sum()
    # Cheapest to raise: segments that meet seldom and hold few shingles.
    raise_cost = held / np.maximum(seen, 1)
    spare_segments = [int(i) for i in np.argsort(share, kind="stable")]
    for hot in (int(i) for i in np.argsort(-share, kind="stable")):
        if share[hot] <= 0:
            break
        if have - filled[hot] >= need:
            values[hot], have = -1, have - filled[hot]
            continue
        cool = next((i for i in spare_segments if values[i] == 0 and i != hot), None)
        if cool is None or share[hot] * MEETING_COST <= raise_cost[cool] or share[cool] * 4 > share[hot]:
            break
        values[cool], values[hot] = 1, -1
        have += filled[cool] - filled[hot]
    return values


def allocation(documents: DataFrame) -> tuple[dict[int, np.ndarray], int]:
    """(values of every costed scheme, number of shingles), from all documents.

    What comes to the driver is a row per segment of at most ``COSTED_BANDS`` schemes.
    """
    measured = documents.select("text").mapInArrow(_measure, "band int, segment int, seen double, met double, held double")
    rows = measured.groupBy("band", "segment").agg(F.sum("seen"), F.sum("met"), F.sum("held")).collect()
    out, total = {}, 0
    for band in sorted({r[0] for r in rows}):
        mine = [r for r in rows if r[0] == band]
        if band == WHOLE:
            total = int(mine[0][2])
            continue
        scheme = Scheme(band)
        seen, met, held = (np.zeros(scheme.segments) for _ in range(3))
        for _, segment, s, m, h in mine:
            seen[segment], met[segment], held[segment] = s, m, h
        out[band] = allocate(scheme, seen, met, held)
    return out, total


# --- signatures ---------------------------------------------------------------


def _signatures(values: dict[int, np.ndarray], buckets: int):
    """Rows (bucket, signatures, documents) of packed arrays, and rows about documents."""

    def value_of(band, segment):
        out = np.zeros(len(band), dtype=np.int8)
        for k in np.unique(band):
            if int(k) in values:
                at = band == k
                out[at] = values[int(k)][segment[at]]
        return out

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, limit=SIGNED_CHARACTERS):
                yield from _emit(piece)
                pa.default_memory_pool().release_unused()

    def _emit(piece):
        ids = piece["doc_id"].to_numpy(zero_copy_only=False).astype(np.int64)
        shingles, sizes = shingle_sets(piece["text"])
        for members, bands, differ in roles(sizes):
            which, band, segment, signature, count, subset, without = subsets(shingles, sizes, members, bands)
            value = value_of(band, segment)
            full = value >= 0
            gone = (value[subset] == 1) & (count[subset] > 1)
            # What the sets of this piece can still sum up to, by set.
            reach = np.bincount(which[full], weights=1.0 + ((value == 1) & (count > 1))[full], minlength=len(members)).astype(np.int64)
            own = None
            if len(members) and (bands == np.floor(np.log2(sizes[members]))).all():
                ends = np.cumsum(sizes)
                own = [parity_sketch(shingles[ends[k] - sizes[k] : ends[k]]) for k in members]
            yield _plain(REACH, buckets, ids[members], sizes[members], bands, reach - differ - 1, own)
            doc = np.concatenate([ids[members][which[full]], ids[members][which[subset[gone]]]])
            role = np.concatenate([bands[which[full]], bands[which[subset[gone]]]])
            mark = np.concatenate([signature[full] & ~np.uint64(1), without[gone] | np.uint64(1)])
            weight = np.concatenate([np.where((value == 1) & (count > 1), 2, 1)[full], np.ones(gone.sum(), dtype=np.int64)])
            yield from _packed(doc, role, mark, weight)

    def _packed(doc, role, mark, weight):
        """One row per bucket; a signature with very many sets of this piece sends its smallest only."""
        order = np.lexsort((doc, mark >> np.uint64(1)))
        doc, role, mark, weight = doc[order], role[order], mark[order], weight[order]
        key = mark >> np.uint64(1)
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        begin = np.flatnonzero(new)
        length = np.diff(np.append(begin, len(key)))
        run_of = np.repeat(np.arange(len(begin)), length)
        hot = length[run_of] > HOT_IN_BATCH
        send = ~hot | new
        if hot.any():
            centre = doc[begin][run_of]
            yield _star(buckets, doc[hot], centre[hot], role[hot], weight[hot])
        bucket = ((mark >> np.uint64(33)) * np.uint64(buckets)) >> np.uint64(31)
        low = (mark & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        bucket, low, doc, band, hot = bucket[send], low[send], doc[send], role[send], hot[send]
        weight = weight[send]
        order = np.argsort(bucket, kind="stable")
        bucket, low, doc, hot = bucket[order], low[order], doc[order], hot[order]
        about = (band[order].astype(np.uint8) << np.uint8(2)) | (weight[order].astype(np.uint8))
        about = about | (hot.astype(np.uint8) << np.uint8(7))
        edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, dtype=np.int64)
        ends = np.append(edges[1:], len(bucket))
        n = len(edges)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, 0, dtype=np.int8)),
                pa.array(bucket[edges].astype(np.int64)),
                pa.array([low[a:b].tobytes() for a, b in zip(edges, ends)], pa.binary()),
                pa.array([doc[a:b].tobytes() for a, b in zip(edges, ends)], pa.binary()),
                pa.array([about[a:b].tobytes() for a, b in zip(edges, ends)], pa.binary()),
                pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
            ],
            names=NAMES,
        )

    return run


NAMES = ["kind", "bucket", "signatures", "documents", "about", "a", "b", "band", "amount"]
EMITTED = (
    "kind byte, bucket long, signatures binary, documents binary, about binary, a long, b long, band int, amount long"
)
PACKED, REACH, STAR = 0, 1, 2


def _plain(kind, buckets, a, b, band, amount, sketch=None) -> pa.RecordBatch:
    """Rows that pass through a bucket unchanged: REACH (set, size, scheme, sum to spare, sketch) or STAR."""
    n = len(a)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, kind, dtype=np.int8)), pa.array(a.astype(np.int64) % buckets),
            pa.nulls(n, pa.binary()) if sketch is None else pa.array(sketch, pa.binary()),
            pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
            pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)),
            pa.array(band.astype(np.int32)), pa.array(amount.astype(np.int64)),
        ],
        names=NAMES,
    )


def _star(buckets, doc, centre, band, weight):
    """STAR rows (set, centre, scheme, sum lost) of hot signatures, equal ones summed."""
    unique, back = np.unique(np.stack([doc, centre, band]), axis=1, return_inverse=True)
    return _plain(STAR, buckets, *unique, np.bincount(back.ravel(), weights=weight))


GROUPED = "kind byte, sketch binary, a long, b long, band int, amount long, list array<long>"
LIST = 3


def _runs(table):
    """Runs of equal signatures in one bucket; other rows pass."""
    kinds = table["kind"].to_numpy()
    passed = table.filter(pa.array(kinds != PACKED)).select(["kind", "signatures", "a", "b", "band", "amount"])
    passed = passed.rename_columns(["kind", "sketch", "a", "b", "band", "amount"])
    passed = passed.append_column("list", pa.nulls(passed.num_rows, pa.list_(pa.int64())))
    table = table.filter(pa.array(kinds == PACKED))
    if not table.num_rows:
        return passed
    low = np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in table["signatures"].to_pylist()])
    doc = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in table["documents"].to_pylist()])
    about = np.concatenate([np.frombuffer(x, dtype=np.uint8) for x in table["about"].to_pylist()])
    key = low >> np.uint32(1)
    order = np.lexsort((doc, key))
    low, doc, about, key = low[order], doc[order], about[order], key[order]
    new = np.append(True, key[1:] != key[:-1])
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(key)))
    run = np.repeat(np.arange(len(begin)), length)
    whole = np.zeros(len(begin), dtype=bool)
    whole[run[(low & np.uint32(1)) == 0]] = True
    several = doc[begin] != doc[begin + length - 1]
    marked = np.zeros(len(begin), dtype=bool)
    marked[run[(about & np.uint8(128)) > 0]] = True
    hot = marked | ((length > LONG_RUN) & several)
    out_a, out_b, out_band, out_amount = [], [], [], []
    is_hot = hot[run]
    if is_hot.any():
        a, b = doc[is_hot], doc[begin][run[is_hot]]
        band, weight = (about[is_hot] & np.uint8(127)) >> np.uint8(2), about[is_hot] & np.uint8(3)
        # What the piece of a marked signature has counted already is not lost twice.
        weight = np.where(about[is_hot] & np.uint8(128), 0, weight)
        unique, back = np.unique(np.stack([a, b, band.astype(np.int64)]), axis=1, return_inverse=True)
        out_a, out_b, out_band = unique
        out_amount = np.bincount(back.ravel(), weights=weight)
    lists = set()
    for r in np.flatnonzero(~hot & several & whole):
        lists.add(tuple(dict.fromkeys(doc[begin[r] : begin[r] + length[r]].tolist())))
    lists = sorted(lists)
    n, k = len(out_a), len(lists)
    found = pa.table(
        {
            "kind": pa.array([STAR] * n + [LIST] * k, pa.int8()),
            "sketch": pa.nulls(n + k, pa.binary()),
            "a": pa.array(list(out_a) + [None] * k, pa.int64()),
            "b": pa.array(list(out_b) + [None] * k, pa.int64()),
            "band": pa.array(list(out_band) + [None] * k, pa.int32()),
            "amount": pa.array([int(x) for x in out_amount] + [None] * k, pa.int64()),
            "list": pa.array([None] * n + [list(x) for x in lists], pa.list_(pa.int64())),
        }
    )
    return pa.concat_tables([passed.cast(found.schema), found])


# --- verification ---------------------------------------------------------------


def parity_sketch(shingles: np.ndarray) -> bytes:
    """Parity of the shingles in each of about two slots per shingle, packed.

    A shingle that two sets do not share changes one slot of one of them, so
    sketches differ in no more slots than the sets in shingles.
    """
    slots = 1 << max(6, int(2 * len(shingles) - 1).bit_length())
    count = np.bincount((mix64(shingles ^ np.uint64(0x5DEECE66D)) & np.uint64(slots - 1)).astype(np.int64), minlength=slots)
    return np.packbits((count & 1).astype(np.uint8)).tobytes()


def _may_link(batches):
    """Pairs whose sketches do not differ by more than linked sets can."""
    for batch in batches:
        keep = []
        for k, (x, y, na, nb) in enumerate(zip(batch["x"], batch["y"], batch["na"].to_pylist(), batch["nb"].to_pylist())):
            a, b = sorted((np.frombuffer(x.as_buffer(), dtype=np.uint8), np.frombuffer(y.as_buffer(), dtype=np.uint8)), key=len)
            while len(b) > len(a):
                b = b[: len(b) // 2] ^ b[len(b) // 2 :]
            if int(np.bitwise_count(a ^ b).sum()) <= allowed(na, nb):
                keep.append(k)
        yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))


def _pack_sets(batches):
    """(doc_id, n, shingles) with sorted shingles as packed bytes."""
    for batch in batches:
        for piece in pieces(batch, limit=PACKED_CHARACTERS):
            shingles, sizes = shingle_sets(piece["text"])
            ends = np.cumsum(sizes)
            packed = [shingles[e - s : e].tobytes() for s, e in zip(sizes, ends)]
            yield pa.RecordBatch.from_arrays([piece["doc_id"], pa.array(sizes), pa.array(packed, pa.binary())], names=["doc_id", "n", "shingles"])


def _linked(batches):
    """Pairs whose sets pass the exact test."""
    for batch in batches:
        keep = []
        for k, (x, y) in enumerate(zip(batch["x"], batch["y"])):
            a, b = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
            common = len(np.intersect1d(a, b, assume_unique=True))
            if common * DENOMINATOR >= NUMERATOR * (len(a) + len(b) - common):
                keep.append(k)
        yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))


def verify(pairs: DataFrame, about: DataFrame, documents: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked.

    Sizes and sketches rule out most pairs for certain; only the sets of the
    others are built and moved. ``about`` is (doc_id, n, sketch).
    """
    sides = [about.select(F.col("doc_id").alias(k), F.col("n").alias(f"n{k}"), F.col("sketch").alias(v)) for k, v in (("a", "x"), ("b", "y"))]
    sizes = F.least("na", "nb") * DENOMINATOR >= F.greatest("na", "nb") * NUMERATOR
    sized = pairs.join(sides[0].drop("x"), "a").join(sides[1].drop("y"), "b").where(sizes).select("a", "b").distinct()
    sketched = sized.join(sides[0], "a").join(sides[1], "b")
    close = scratch_table(sketched.mapInArrow(_may_link, "a long, b long").distinct(), "close")
    nodes = scratch_table(close.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "nodes")
    chosen = documents.join(broadcast_if_small(nodes), "doc_id", "left_semi")
    sets = scratch_table(chosen.mapInArrow(_pack_sets, "doc_id long, n long, shingles binary"), "sets")
    joined = close
    for side, value in (("a", "x"), ("b", "y")):
        joined = joined.join(sets.select(F.col("doc_id").alias(side), F.col("shingles").alias(value)), side)
    return scratch_table(joined.select("a", "b", "x", "y").mapInArrow(_linked, "a long, b long").distinct(), "links")


def _held(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """(doc_id, n, shingle) of the sets the signatures do not suffice for."""
    chosen = documents.join(broadcast_if_small(nodes), "doc_id", "left_semi")
    return scratch_table(chosen.select("doc_id", "text").mapInArrow(_explode, "doc_id long, n long, shingle long"), "held")


def _prefix(held: DataFrame, labels: DataFrame) -> DataFrame:
    """The first shingles of each set that other components hold too, with their places.

    Shingles are ordered by the number of components that hold them; linked
    sets share one of their first n - ceil(3 n / 4) + 1 shingles.
    """
    named = held.join(broadcast_if_small(labels.withColumnRenamed("node", "doc_id")), "doc_id", "left")
    named = named.withColumn("component", F.coalesce("component", "doc_id"))
    spread = named.groupBy("shingle", "component").agg(F.lit(1).alias("one")).groupBy("shingle").agg(F.count("one").alias("components"))
    place = F.row_number().over(Window.partitionBy("doc_id", "n").orderBy("components", "shingle"))
    reach = F.col("n") - F.ceil(F.col("n") * NUMERATOR / DENOMINATOR) + 1
    placed = named.join(spread, "shingle").withColumn("place", place)
    return scratch_table(placed.where((F.col("place") <= reach) & (F.col("components") > 1)), "prefix")


def _centres(prefix: DataFrame, turn: int) -> DataFrame:
    """Pairs of every set with one set, drawn by a hash, of each of its prefix shingles."""
    drawn = prefix.groupBy("shingle").agg(F.min_by(F.struct("doc_id", "component", "n"), F.xxhash64("doc_id", F.lit(turn))).alias("c"))
    paired = prefix.join(drawn, "shingle").where(F.col("component") != F.col("c.component"))
    fits = F.least("n", "c.n") * DENOMINATOR >= F.greatest("n", "c.n") * NUMERATOR
    return paired.where(fits).select(F.greatest("doc_id", "c.doc_id").alias("a"), F.least("doc_id", "c.doc_id").alias("b")).distinct()


SLOTS = 256


def _parities(held: DataFrame) -> DataFrame:
    """(doc_id, n, p0..p3): parity of a set's shingles in each of ``SLOTS`` slots; none where an id has several sets."""
    slot = F.pmod(F.xxhash64("shingle"), F.lit(SLOTS)).cast("int")
    rows = held.select("doc_id", "n", slot.alias("slot"))
    bit = F.expr("shiftleft(1L, slot % 64)")
    parts = [F.bit_xor(F.when(F.floor(F.col("slot") / 64) == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"p{k}") for k in range(SLOTS // 64)]
    sums = rows.groupBy("doc_id", "n").agg(F.count(F.lit(1)).alias("held"), *parts)
    return sums.where("held = n").drop("held")


def _rare(prefix: DataFrame, held: DataFrame) -> DataFrame:
    """All candidate pairs that share a prefix shingle and are in different components.

    At the first shingle two sets share, no more can be in common than what
    either has from there on, which rules out sets whose own shingles stand in
    front. Shingles with the same sets, as those of one passage have, give the
    same pairs: the first of them stands for all. Sets are told by sums of hashes.
    """
    sums = [F.sum(F.pmod(F.xxhash64("doc_id", F.lit(k)), F.lit(1 << 31))).alias(f"s{k}") for k in range(4)]
    holders = prefix.groupBy("components", "shingle").agg(F.count(F.lit(1)).alias("sets"), *sums)
    first = holders.groupBy("sets", "s0", "s1", "s2", "s3").agg(F.min(F.struct("components", "shingle")).alias("first")).where("sets > 1")
    prefix = prefix.join(first.select("first.shingle"), "shingle", "left_semi").drop("components")
    prefix = scratch_table(prefix.join(_parities(held), ["doc_id", "n"], "left"), "prefix")
    other = prefix.select(*(F.col(c).alias(f"{c}_b") for c in prefix.columns))
    met = prefix.join(other, (F.col("shingle") == F.col("shingle_b")) & (F.col("component") < F.col("component_b")))
    left = F.least(F.col("n") - F.col("place"), F.col("n_b") - F.col("place_b")) + 1
    fits = left * (NUMERATOR + DENOMINATOR) >= (F.col("n") + F.col("n_b")) * NUMERATOR
    # Sets differ in no fewer shingles than slots in parity.
    differ = sum((F.bit_count(F.col(f"p{k}").bitwiseXOR(F.col(f"p{k}_b"))) for k in range(SLOTS // 64)), F.lit(0))
    fits = fits & F.coalesce(differ * (NUMERATOR + DENOMINATOR) <= (F.col("n") + F.col("n_b")) * (DENOMINATOR - NUMERATOR), F.lit(True))
    return met.where(fits).select(F.col("doc_id").alias("a"), F.col("doc_id_b").alias("b")).distinct()


def _explode(batches):
    for batch in batches:
        for piece in pieces(batch, limit=PACKED_CHARACTERS):
            shingles, sizes = shingle_sets(piece["text"])
            ids = piece["doc_id"].to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, sizes)), pa.array(np.repeat(sizes, sizes)), pa.array(shingles.view(np.int64))], names=["doc_id", "n", "shingle"]
            )


def links(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(links, components, sizes) of documents (doc_id not null, text).

    ``links`` are verified pairs (a, b) that join all components, ``components``
    is (node, component), ``sizes`` (doc_id, n_shingles) of sets with shingles.
    """
    small_batches(documents.sparkSession)
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    values, total = allocation(documents)
    # About two signatures to three shingles.
    buckets = max(16, total * 2 // 3 // SIGNATURES_PER_BUCKET)
    emitted = documents.mapInArrow(_signatures(values, buckets), EMITTED)
    runs = scratch_table(emitted.groupBy("bucket").applyInArrow(_runs, GROUPED), "runs")
    lists = scratch_table(runs.where(F.col("kind") == LIST).select("list").distinct(), "lists")
    stars, reach = (runs.where(F.col("kind") == kind).select("a", "b", "band", "amount") for kind in (STAR, REACH))
    centred = lists.select(F.explode(F.slice("list", 2, LONG_RUN)).alias("a"), F.col("list")[0].alias("b"))
    first = scratch_table(stars.select("a", "b").unionByName(centred).where("a <> b").distinct(), "stars")
    lost = stars.groupBy("a", "band").agg(F.sum("amount").alias("lost"))
    short = scratch_table(
        reach.join(lost, ["a", "band"], "left").where(F.col("amount") < F.coalesce("lost", F.lit(0))).select(F.col("a").alias("doc_id")).distinct(),
        "short",
    )
    about = scratch_table(
        runs.where((F.col("kind") == REACH) & F.col("sketch").isNotNull()).select(F.col("a").alias("doc_id"), F.col("b").alias("n"), "sketch"), "about"
    )
    found = verify(first, about, documents)
    labels = components(found)
    # Sets that fall short are linked to drawn centres of their rarest shingles
    # first, so that few of them are still apart when all pairs are formed.
    held, tried = _held(documents, short), first.select("a", "b")
    for turn in range(CENTRE_ROUNDS):
        pairs = scratch_table(_centres(_prefix(held, labels), turn).join(tried, ["a", "b"], "left_anti"), "centres")
        more = verify(pairs, about, documents)
        tried = tried.unionByName(pairs)
        if more.isEmpty():
            break
        found = scratch_table(found.unionByName(more), "links")
        labels = components(found)
    # Second round: what is still apart after the first.
    listed = lists.withColumn("id", F.xxhash64("list")).select("id", F.explode("list").alias("doc_id"))
    known_sizes = labels.withColumnRenamed("node", "doc_id").join(about.select("doc_id", "n"), "doc_id", "right")
    named = listed.join(broadcast_if_small(scratch_table(known_sizes, "named")), "doc_id").withColumn("component", F.coalesce("component", "doc_id"))
    apart = named.groupBy("id").agg(F.collect_set(F.struct("component", "doc_id", "n")).alias("members"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    one = apart.select(F.explode("members").alias("m"), "members").select("m", F.explode("members").alias("o"))
    near = F.least("m.n", "o.n") * DENOMINATOR >= F.greatest("m.n", "o.n") * NUMERATOR
    crossing = one.where("m.component < o.component").where(near).select(F.col("m.doc_id").alias("a"), F.col("o.doc_id").alias("b"))
    again = crossing.unionByName(_rare(_prefix(held, labels), held)).distinct()
    known = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    second = verify(scratch_table(again.join(known, ["a", "b"], "left_anti"), "second"), about, documents)
    every = found.unionByName(second)
    sizes = about.groupBy("doc_id").agg(F.max("n").alias("n_shingles"))
    return every, components(every), sizes


def _own_sizes(batches):
    for batch in batches:
        for piece in pieces(batch, limit=PACKED_CHARACTERS):
            _, sizes = shingle_sets(piece["text"])
            yield pa.RecordBatch.from_arrays([piece["doc_id"], pa.array(sizes, pa.int64())], names=["doc_id", "n_shingles"])


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    _, labels, sizes = links(documents.where(F.col("doc_id").isNotNull()))
    about = scratch_table(sizes.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left"), "about")
    found = documents.select("doc_id").join(broadcast_if_small(about), "doc_id", "left").select(
        "doc_id", F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )
    # Where an id does not tell a row, the size of its own set is counted anew.
    unclear = scratch_table(documents.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("id")), "unclear")
    if unclear.isEmpty():
        return found
    same = F.col("doc_id").eqNullSafe(F.col("id"))
    own = documents.join(broadcast_if_small(unclear), same, "left_semi").mapInArrow(_own_sizes, "doc_id long, n_shingles long")
    own = own.join(broadcast_if_small(about.select("doc_id", "component")), "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return found.join(broadcast_if_small(unclear), same, "left_anti").unionByName(own)
