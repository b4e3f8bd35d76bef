"""Best-fit packing of tokenised documents by bulk-synchronous rounds.

A document is its tokens and an end mark; only one longer than a sequence is
cut. Pieces longer than half a sequence open sequences of their own. The other
pieces are placed in bands of length, long ones first. In a round

1. the pieces of the band and the gaps of the open sequences are range-sorted by
   size (a gap that holds several pieces of the band offers as many slots),
2. one sweep from large to small lets every piece take the smallest free slot
   that holds it, its successor: slots count up, pieces count down, and a piece
   belongs to the last slot before it on the same level. Running sums within a
   part and one row per part give the levels, so no task sees all rows. Pieces
   that compete for a slot are settled by their rank: the longer one takes it,
   the others go on to the next free one,
3. the gaps shrink by what they took, and the round is repeated.

When a round places few of them, sequences for the rest of the band are opened:
as many as its words fill, or, for the last few pieces, as many as hold a slot
for each.
Each round reads and writes tables, so a lost executor costs a reread.

Memory: a batch of texts, and as many distinct words as ``CACHED_WORDS``. Words
between white space are coded once per batch: white space never is part of a
token, and no token spans it.

Defined results: a null or empty text is its end mark alone; rows with equal
ids, or without one, are documents of their own; ties in length are settled by
the row's number in the written pieces, so a rerun on the same files agrees; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import string
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyloom.llm.ordering import numbered, range_marked
from tallyloom.llm.shingles import pieces as slices
from tallyloom.operators.sizing import broadcast_if_small
from tallyloom.session import scratch_table

CAPACITY = 2048
END = 0
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
# Characters coded together, and words kept from batch to batch.
CODED, CACHED_WORDS = 6_000_000, 500_000
LONGEST_CACHED = 64
# New words are coded in groups, between marks that no word holds.
GROUPED, MARK = 512, "\x01"
CLOSING = string.punctuation
# A word of these letters alone is one piece that the vocabulary's normaliser leaves
# as it is; the model takes its bytes, each written as a printable character.
LETTERS = re.compile("[a-zß-öø-ÿ]+")
PRINTED = {b: 256 + n for n, b in enumerate([*range(33), *range(127, 161), 173])}


# --- tokens ---------------------------------------------------------------------


def parted(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Words without white space as (stem, closing marks), which are coded apart.

    Letters and punctuation never share a token and case does not matter, so
    words that differ in capitals or in closing marks have one stem. Its last
    letter is one whose lower case is a letter, not one with a mark. Words with
    combining marks, which a capital may join otherwise, and those that could
    hold a special token stay as they are.
    """
    lowered = pc.ascii_lower(words)
    plain = pc.invert(pc.match_substring_regex(words, rf"\pM|<\||{MARK}"))
    stem = pc.utf8_rtrim(lowered, characters=CLOSING)
    split = pc.and_(plain, pc.match_substring_regex(stem, "[a-zÀ-ÖØ-öø-ÿ]$"))
    closing = pc.struct_field(pc.extract_regex(lowered, rf"(?P<closing>[{re.escape(CLOSING)}]*)$"), "closing")
    return pc.if_else(split, stem, pc.if_else(plain, lowered, words)), pc.if_else(split, closing, "")


@dataclass
class Coder:
    """Token ids of many texts, packed; words between white space are coded once."""

    tokenizer: Tokenizer
    known: dict[str, bytes]

    def _encoded(self, words: list[str]) -> dict[str, bytes]:
        """Ids of new words: one piece by the model alone, others in groups between marks, which white space parts from them."""
        [mark] = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        out: dict[str, bytes] = {}
        model, rest = self.tokenizer.model, []
        for w in words:
            if LETTERS.fullmatch(w):
                printed = w if w.isascii() else w.encode().decode("latin-1").translate(PRINTED)
                out[w] = array("I", [token.id for token in model.tokenize(printed)]).tobytes()
            else:
                rest.append(w)
        odd = [w for w in rest if MARK in w or "<|" in w]
        plain = [w for w in rest if not (MARK in w or "<|" in w)]
        for start in range(0, len(plain), GROUPED):
            group = plain[start : start + GROUPED]
            ids = np.array(self.tokenizer.encode(f" {MARK} ".join(group), add_special_tokens=False).ids, dtype="<u4")
            at = np.flatnonzero(ids == mark).tolist()
            if len(at) != len(group) - 1:
                odd += group
                continue
            raw = ids.tobytes()
            out.update((w, raw[4 * a : 4 * b]) for w, a, b in zip(group, [0, *(k + 1 for k in at)], [*at, len(ids)]))
        for w in odd:
            out[w] = np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return out

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, packed; the ones that are new are coded together."""
        known = self.known
        fresh = self._encoded([w for w in words if w not in known])
        out = [known[w] if w in known else fresh[w] for w in words]
        if len(known) + len(fresh) > CACHED_WORDS:
            known.clear()
        known.update((w, ids) for w, ids in fresh.items() if len(w) <= LONGEST_CACHED)
        return out

    def code(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, each with its end mark; number of ids of each text)."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        owner = pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
        coded = split.flatten().dictionary_encode()
        stems, closings = (part.dictionary_encode() for part in parted(coded.dictionary))
        ids = self._ids(stems.dictionary.to_pylist()) + self._ids(closings.dictionary.to_pylist())
        ids.append(np.array([END], dtype="<u4").tobytes())
        # A word is its stem and its closing marks; behind the words of a text comes the end mark.
        places = coded.indices.to_numpy(zero_copy_only=False)
        stem, closing = (part.indices.to_numpy(zero_copy_only=False) for part in (stems, closings))
        counts = np.bincount(owner, minlength=len(texts))
        ends = np.cumsum(2 * counts + 1) - 1
        codes = np.empty(2 * len(places) + len(texts), dtype=np.int32)
        inside = np.ones(len(codes), dtype=bool)
        inside[ends] = False
        codes[ends] = len(ids) - 1
        codes[inside] = np.column_stack([stem[places], closing[places] + len(stems.dictionary)]).ravel() if len(places) else np.zeros(0, np.int32)
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        begins = np.cumsum(lengths) - lengths
        taken = lengths[codes]
        upto = np.cumsum(taken)
        at = np.repeat(begins[codes] - (upto - taken), taken) + np.arange(upto[-1] if len(upto) else 0)
        sizes = np.diff(upto[ends], prepend=0) if len(texts) else np.zeros(0, dtype=np.int64)
        return np.frombuffer(b"".join(ids), dtype="<u4")[at], sizes.astype(np.int64)


@lru_cache(maxsize=1)
def coder_of(vocabulary: str) -> Coder:
    """The coder of a worker, kept from task to task."""
    return Coder(Tokenizer.from_str(vocabulary), {})


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(vocabulary, capacity: int, with_ids: bool):
    def run(batches) -> Iterator[pa.RecordBatch]:
        # Tasks run beside each other already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        coder = coder_of(vocabulary.value)
        for batch in batches:
            for part in slices(batch, limit=CODED):
                ids, sizes = coder.code(part["text"])
                count = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), count)
                piece = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(sizes[row] - start, capacity)
                first = (np.cumsum(sizes) - sizes)[row] + start
                held = [ids[a : a + n] for a, n in zip(first.tolist(), length.tolist())]
                columns = [
                    part["doc_id"].take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                    pa.array([crc32(h.tobytes()) for h in held], pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([h.astype(np.int32) for h in held], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def token_pieces(documents: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document.

    The vocabulary file is read once, by the driver, and sent to the tasks.
    """
    with open(vocabulary, encoding="utf-8") as file:
        shared = documents.sparkSession.sparkContext.broadcast(file.read())
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_cut(shared, capacity, with_ids), PIECE + (", ids array<int>" if with_ids else ""))


# --- packing ----------------------------------------------------------------------

# Bands end at these parts of a sequence.
BANDS = (2, 4, 8, 32, 128)
# A round that places less than this share of its pieces, or the last of so
# many, is followed by new sequences.
WORTH, ROUNDS = 0.2, 4
# Share of the pieces of a band that counts as few.
FEW = 0.03


def _running(batches):
    """Adds the sum of steps (slots +1, pieces -1) up to each row and the least sum before it, within a part."""
    parts: dict[int, tuple[int, int]] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch["part"].to_numpy(zero_copy_only=False)
        step = np.where(batch["taker"].to_numpy(zero_copy_only=False), -1, 1)
        sums, lows = np.empty(len(step), dtype=np.int64), np.empty(len(step), dtype=np.int64)
        edges = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        for a, b in zip(edges, np.append(edges[1:], len(part))):
            before, low = parts.get(int(part[a]), (0, 0))
            run = before + np.cumsum(step[a:b])
            least = np.minimum(low, np.minimum.accumulate(run))
            sums[a:b] = run
            lows[a:b] = np.append(low, least[:-1])
            parts[int(part[a])] = (int(run[-1]), int(least[-1]))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums), pa.array(lows)], names=[*batch.schema.names, "sum", "low"])


def _swept(pieces: DataFrame, gaps: DataFrame, longest: int, shortest: int) -> tuple[DataFrame, int, int]:
    """Pieces (row, length) with the sequence they take (null: none), how many found one, and the length of the others."""
    count = F.greatest(F.lit(1), F.floor(F.col("room") / longest))
    slots = gaps.where(F.col("room") > shortest).select("sequence", "room", count.alias("count"), F.explode(F.sequence(F.lit(1), count)).alias("slot"))
    last = F.col("slot") == F.col("count")
    size = F.when(last, F.col("room") - (F.col("count") - 1) * longest).otherwise(F.lit(longest))
    slots = slots.select(size.cast("long").alias("size"), F.lit(False).alias("taker"), F.col("sequence").alias("key"), F.col("slot").cast("long").alias("slot"))
    takers = pieces.select(F.col("length").alias("size"), F.lit(True).alias("taker"), F.col("row").alias("key"), F.lit(0).cast("long").alias("slot"))
    # At one size slots come first: a piece may fill a gap exactly.
    by = [F.col("size").desc(), F.col("taker").asc(), F.col("key").asc(), F.col("slot").asc()]
    ordered = range_marked(slots.unionByName(takers), by)
    summed = ordered.mapInArrow(_running, "size long, taker boolean, key long, slot long, part long, place long, sum long, low long")
    summed = scratch_table(summed, "summed")
    step = F.when(F.col("taker"), -1).otherwise(1)
    ends = summed.groupBy("part").agg(F.sum(step).alias("total"), F.min(F.least("sum", "low")).alias("least"))
    # One row per part.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("carry", F.coalesce(F.sum("total").over(before), F.lit(0)))
    carried = carried.select("part", "carry", F.coalesce(F.min(F.col("carry") + F.col("least")).over(before), F.lit(0)).alias("floor"))
    placed = summed.join(broadcast_if_small(carried), "part")
    # Pieces that found no slot hold the sum down; the level counts from there.
    floor = F.least(F.lit(0), "floor", F.col("carry") + F.col("low"))
    level = F.col("carry") + F.col("sum") + F.col("taker").cast("int") - floor
    levelled = placed.select("part", "place", "taker", "key", F.col("size").alias("length"), level.alias("level"))
    # On one level slots and pieces alternate: at most two rows for every size.
    same = Window.partitionBy("level").orderBy("part", "place")
    matched = levelled.where("level > 0").withColumn("sequence", F.lag("key").over(same)).where("taker").select(F.col("key").alias("row"), "length", "sequence")
    left = levelled.where("taker AND level = 0").select(F.col("key").alias("row"), "length", F.lit(None).cast("long").alias("sequence"))
    seen = Observation()
    found = matched.unionByName(left).observe(
        seen, F.count("sequence").alias("placed"), F.coalesce(F.sum(F.when(F.col("sequence").isNull(), F.col("length"))), F.lit(0)).alias("left")
    )
    found = scratch_table(found, "found")
    return found, seen.get["placed"], seen.get["left"]


def place(pieces: DataFrame, capacity: int = CAPACITY, bands: Sequence[int] = BANDS) -> DataFrame:
    """(row, sequence) of pieces (row, length), with as few sequences as best fit finds."""
    spark = pieces.sparkSession
    edges = [capacity // b for b in bands if capacity // b > 0] + [0]
    own = pieces.where(F.col("length") > edges[0]).select("row", "length", F.col("row").alias("sequence"))
    done = [own.select("row", "sequence")]
    gaps = scratch_table(own.select("sequence", (F.lit(capacity).cast("long") - F.col("length")).alias("room")).where("room > 0"), "gaps")
    fresh = (pieces.agg(F.max("row")).first()[0] or 0) + 1
    for longest, shortest in zip(edges, edges[1:]):
        waiting = pieces.where((F.col("length") <= longest) & (F.col("length") > shortest)).select("row", "length")
        size, longest = waiting.agg(F.count(F.lit(1)), F.max("length")).first()
        rounds, band = 0, size
        while size:
            found, placed, words = _swept(waiting, gaps, longest, shortest)
            rounds += 1
            done.append(found.where("sequence IS NOT NULL").select("row", "sequence"))
            waiting = found.where("sequence IS NULL").select("row", "length")
            taken = found.where("sequence IS NOT NULL").groupBy("sequence").agg(F.sum("length").alias("taken"))
            gaps = gaps.join(taken, "sequence", "left").select("sequence", (F.col("room") - F.coalesce("taken", F.lit(0))).alias("room")).where("room > 0")
            worth, size = placed > WORTH * size, size - placed
            if size and (not worth or rounds == ROUNDS):
                # As many as the words need; where few pieces of the band are left, a slot for each.
                few = size <= FEW * band
                opened = max(-(-words // capacity), -(-size // (capacity // longest)) if few else 0)
                gaps = gaps.unionByName(spark.range(fresh, fresh + opened).select(F.col("id").alias("sequence"), F.lit(capacity).cast("long").alias("room")))
                fresh, rounds = fresh + opened, 0
            gaps = scratch_table(gaps, "gaps")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``, their place in it without gaps."""
    pieces = numbered(pieces, "pieces")
    placed = pieces.join(place(pieces.select("row", "length"), capacity).withColumnRenamed("sequence", "sequence_id"), "row")
    # A sequence has at most ``capacity`` pieces.
    inside = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "row").rowsBetween(Window.unboundedPreceding, 0)
    return placed.withColumn("offset", F.sum("length").over(inside) - F.col("length")).drop("row")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids) of packed pieces that hold their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
