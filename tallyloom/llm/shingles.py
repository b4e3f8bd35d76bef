"""Word shingles of whole texts as 64-bit hashes, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import SparkSession

# Characters of text that are shingled together; a longer text is taken alone.
PIECE_CHARACTERS = 3_000_000
# Rows with a text, or a packed set, that travel to a task's Python together.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the session's bound on rows of an Arrow batch, which by default holds 10,000 texts at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_CHARACTERS) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with a bounded amount of text each."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


# Words of more bytes are hashed one by one.
LONG_WORD = 256


def hashes_of(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word (no nulls), eight bytes of all of them at a time."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    _, places, data = words.buffers()
    kind = np.int64 if pa.types.is_large_string(words.type) else np.int32
    ends = np.frombuffer(places, dtype=kind)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    # Eight bytes behind the last word, so that every load stays inside.
    raw = np.zeros(int(ends[-1]) + 8, dtype=np.uint8)
    if data is not None:
        raw[: ends[-1]] = np.frombuffer(data, dtype=np.uint8)[: ends[-1]]
    loads = np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    begin, length = ends[:-1], np.diff(ends)
    out = mix64(length.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    at, done = np.flatnonzero((length > 0) & (length <= LONG_WORD)), 0
    while len(at):
        left = length[at] - done
        keep = np.where(left < 8, (np.uint64(1) << (np.uint64(8) * np.minimum(left, 7).astype(np.uint64))) - np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF))
        out[at] = mix64(out[at] * np.uint64(0xD6E8FEB86659FD93) + (loads[begin[at] + done] & keep))
        at, done = at[left > 8], done + 8
    for k in np.flatnonzero(length > LONG_WORD).tolist():
        out[k] = xxhash.xxh3_64_intdigest(raw[begin[k] : begin[k] + length[k]].tobytes())
    return out


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, text each word is of); A-Z count as a-z."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    owner = pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
    coded = split.flatten().dictionary_encode()
    table = hashes_of(coded.dictionary)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    blank = pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    keep = ~blank[codes] if len(table) else np.zeros(0, dtype=bool)
    return table[codes[keep]] if len(table) else np.zeros(0, np.uint64), owner[keep].astype(np.int64)


def shingle_sets(texts: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes grouped by text, number of them for each text).

    A text with fewer words than ``width`` has its whole sequence as the one
    shingle; a text without words has none.
    """
    hashes, owner = word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    starts = np.cumsum(counts) - counts
    rolled = np.zeros(len(hashes), dtype=np.uint64)
    place = np.arange(len(hashes)) - starts[owner]
    left = counts[owner] - place
    for j in range(width):
        # Words beyond the end count as 0, which only short texts keep.
        shifted = np.zeros(len(hashes), dtype=np.uint64)
        shifted[: max(0, len(hashes) - j)] = hashes[j:]
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + np.where(left > j, mix64(shifted + np.uint64(j + 1)), np.uint64(0))
    keep = (left >= width) | ((place == 0) & (counts[owner] < width))
    rolled, owner = mix64(rolled[keep]), owner[keep]
    order = np.lexsort((rolled, owner))
    rolled, owner = rolled[order], owner[order]
    new = np.ones(len(rolled), dtype=bool)
    new[1:] = (rolled[1:] != rolled[:-1]) | (owner[1:] != owner[:-1])
    return rolled[new], np.bincount(owner[new], minlength=len(texts)).astype(np.int64)
