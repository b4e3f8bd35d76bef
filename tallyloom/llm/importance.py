"""Importance resampling towards a target distribution, with features hashed by prefix CRCs.

A text is scanned once. Its words, joined by single separators, form one byte
string whose running CRC is kept at the begin and the end of every word. The
CRC of any n-gram follows from two of them: shifting the CRC of what lies
before the n-gram by the n-gram's length (a linear map over GF(2)) and adding
it to the CRC at its end cancels everything before. No n-gram is built as text.

The features' buckets are written once; counts of all rows and of the target
give every bucket a gain, the mean gain of a row's features is its weight, and
Gumbel noise from a digest of its id turns the highest scores into a draw
without replacement in proportion to the weights' exponentials.

Defined results: a null or empty text, or one without words, has no features
and weight 0; a row without an id draws its noise from an empty id and comes
after others of its score; rows with equal score and id follow each other by
their number of features, equal rows in any order; an empty table gives no
rows; an empty target counts 0 in every bucket; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.ordering import numbered, range_sorted, ranked
from tallyloom.llm.shingles import pieces
from tallyloom.session import scratch_table

ORDER, BUCKETS = 2, 10_000
MIN_WORDS, PERCENT, SEED = 20, 25, 7
SCALE = 1000
# Characters of text that are scanned together; a longer text is taken alone.
SCANNED = 500_000

_UPPER, _DIGITS, _LOWER = range(0x41, 0x5B), range(0x30, 0x3A), range(0x61, 0x7B)
# Bytes outside of words become a separator, A-Z become a-z.
NORMAL = bytes(b + 32 if b in _UPPER else b if b >= 0x80 or b in _DIGITS or b in _LOWER else 0x20 for b in range(256))


# --- CRC of a substring from two prefixes ----------------------------------------

_POLYNOMIAL = 0xEDB88320


def _columns_to_table(columns: list[int]) -> np.ndarray:
    """4 x 256 lookups of a linear map given by its 32 columns."""
    table = np.zeros((4, 256), dtype=np.uint32)
    for byte in range(4):
        for bit in range(8):
            held = (np.arange(256) >> bit & 1).astype(bool)
            table[byte, held] ^= np.uint32(columns[8 * byte + bit])
    return table


def _apply(columns: list[int], value: int) -> int:
    out = 0
    for k, column in enumerate(columns):
        if value >> k & 1:
            out ^= column
    return out


@cache
def _shift_columns(power: int) -> tuple[int, ...]:
    """Columns of the map that appends 2 ** power zero bytes."""
    if power == 0:
        columns = []
        for k in range(32):
            value = 1 << k
            for _ in range(8):
                value = value >> 1 ^ (_POLYNOMIAL if value & 1 else 0)
            columns.append(value)
        return tuple(columns)
    half = list(_shift_columns(power - 1))
    return tuple(_apply(half, c) for c in half)


@cache
def _shift_table(power: int) -> np.ndarray:
    return _columns_to_table(list(_shift_columns(power)))


def shifted(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs after as many zero bytes as given, one step per bit of the lengths."""
    out, power = crcs.astype(np.uint32, copy=True), 0
    left = lengths.astype(np.int64, copy=True)
    while left.any():
        at = np.flatnonzero(left & 1)
        if len(at):
            table, value = _shift_table(power), out[at]
            out[at] = (
                table[0][value & np.uint32(0xFF)] ^ table[1][value >> np.uint32(8) & np.uint32(0xFF)]
                ^ table[2][value >> np.uint32(16) & np.uint32(0xFF)] ^ table[3][value >> np.uint32(24)]
            )
        left >>= 1
        power += 1
    return out


def substring_crc(before: np.ndarray, upto: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC of substrings: of the prefixes before them and up to their ends."""
    return upto ^ shifted(before, lengths)


@dataclass(frozen=True)
class Scan:
    """Running CRCs of the words of several texts, scanned as one string."""

    begin: np.ndarray
    end: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    owner: np.ndarray

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(CRC, text) of all runs of n words of one text, in order."""
        last = np.arange(n - 1, len(self.owner))
        first = last - (n - 1)
        same = self.owner[first] == self.owner[last]
        first, last = first[same], last[same]
        return substring_crc(self.begin[first], self.end[last], self.stops[last] - self.starts[first]), self.owner[first]


def scan(texts: list[bytes | None]) -> Scan:
    """One pass over all texts; words of different texts are joined by a separator too."""
    split = [(t or b"").translate(NORMAL).split() for t in texts]
    counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    words = [w for one in split for w in one]
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    # Each step takes a word and the separator before it.
    end = np.fromiter(accumulate(words, lambda crc, word: crc32(word, crc32(b" ", crc)), initial=0), dtype=np.uint32, count=len(words) + 1)
    state = end[:-1] ^ np.uint32(0xFFFFFFFF)
    begin = (state >> np.uint32(8) ^ _byte_table()[(state ^ np.uint32(0x20)) & np.uint32(0xFF)]) ^ np.uint32(0xFFFFFFFF)
    stops = np.cumsum(lengths + 1)
    return Scan(begin, end[1:], stops - lengths, stops, np.repeat(np.arange(len(texts)), counts))


@cache
def _byte_table() -> np.ndarray:
    """Change of the state by its lowest byte."""
    return _shift_table(0)[0]


# --- features, counts, weights -----------------------------------------------------

FEATURES = "doc_id long, n_words long, n_features long, buckets binary"


def _features(order: int, buckets: int):
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, limit=SCANNED):
                texts = piece["text"].cast(pa.binary()).to_pylist()
                scanned = scan(texts)
                found = [scanned.ngrams(n) for n in range(1, order + 1)]
                crcs, owner = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
                by_text = np.argsort(owner, kind="stable")
                held = (crcs % np.uint32(buckets)).astype(kind)[by_text]
                sizes = np.bincount(owner, minlength=len(texts))
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece["doc_id"], pa.array(np.bincount(scanned.owner, minlength=len(texts)), pa.int64()), pa.array(sizes, pa.int64()),
                        pa.array([held[e - s : e].tobytes() for s, e in zip(sizes, ends)], pa.binary()),
                    ],
                    names=["doc_id", "n_words", "n_features", "buckets"],
                )

    return run


def features(documents: DataFrame, order: int = ORDER, buckets: int = BUCKETS, key: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_features, buckets): the buckets of all features of a text, packed."""
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_features(order, buckets), FEATURES)


def counts(featured: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features fall into each bucket, summed per task before the shuffle."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for one in batch["buckets"]:
                total += np.bincount(np.frombuffer(one.as_buffer(), dtype=kind), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["bucket", "n"])

    return featured.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Scaled log ratio of target to corpus in every bucket; at most ``buckets`` rows of each side come to the driver."""

    def counted(df):
        out = np.zeros(buckets, dtype=np.int64)
        for bucket, n in df.collect():
            out[bucket] = n
        return out

    s, t = counted(corpus), counted(target)
    return np.floor(SCALE * np.log((t + 1.0) * (s.sum() + buckets) / ((s + 1.0) * (t.sum() + buckets)))).astype(np.int64)


def weights(featured: DataFrame, gain: np.ndarray, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, weight)."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32
    shared = featured.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        for batch in batches:
            table = shared.value
            sums = [int(table[np.frombuffer(one.as_buffer(), dtype=kind)].sum()) for one in batch["buckets"]]
            means = [s // n if n else 0 for s, n in zip(sums, batch["n_features"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_words"], batch["n_features"], pa.array(means, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"]
            )

    return featured.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(key: Column, seed: int = SEED) -> Column:
    """Scaled Gumbel noise from a digest of the id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def resample(documents: DataFrame, target: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT, order: int = ORDER, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; ``rank`` is null for rows not drawn."""
    featured = scratch_table(features(documents, order, buckets), "features")
    aimed = features(target.withColumn("doc_id", F.lit(None).cast("long")), order, buckets)
    gain = gains(counts(featured, buckets), counts(aimed, buckets), buckets)
    scored = weights(featured, gain, buckets).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = numbered(scored, "scored")
    able = F.col("n_words") >= min_words
    ordered = range_sorted(scored.where(able), [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(), F.col("row").asc()], "ordered")
    drawn = F.col("rank") < F.floor(F.col("total") * percent / 100)
    ranks = ranked(ordered).withColumn("rank", F.when(drawn, F.col("rank") + 1))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranks.select(columns).unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")).select(columns))
