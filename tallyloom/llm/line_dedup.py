"""Substring duplicates: sentences and lines by their digests.

A text is cut into sentences at line ends and sentence ends, and a sentence of
``2 * min_words`` words or more also where its own words say so: before a word
whose pair with the word before it has the least hash of all places up to
``min_words - 1`` words away. Such a place depends on the words around it only,
so a passage that begins or ends inside longer sentences is cut alike wherever
it stands, but for its first and last pieces. No piece has less than
``min_words`` words; where four times as many words have no such place (words
that repeat in short turns), the sentence is cut every ``2 * min_words`` words.
Units are normalised
(lower case, runs of white space as one space) and hashed to 128 bits; a unit
of less than ``min_words`` words is hashed together with the words before it, up
to that many, so a short phrase alone is no duplicate. Digests are grouped globally, the
occurrence in the smallest document id, at its smallest offset, is kept, and
every other one is removed, with the offsets of the original text retained.

Within a document repeats are settled before the shuffle, so each document
sends a digest once; sums per digest are made before the shuffle as well, and
only digests that occur again are joined back.

Defined results: null and empty texts have no units; a document without an id
keeps a digest only if no document with one has it; repeated rows (same id,
same text) count as one document; an empty table gives no rows; other columns
of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.compression import texts_of
from tallyloom.session import scratch_table

MIN_WORDS = 6
UNIT = re.compile(r"[^.!?\n]*(?:[.!?]+|\n|$)")
WORD = re.compile(r"\S+")


def places(sentences: list[list[str]], min_words: int = MIN_WORDS) -> list[list[int]]:
    """Numbers of the words before which each sentence is cut."""
    long = [k for k, words in enumerate(sentences) if len(words) >= 2 * min_words]
    cuts: list[list[int]] = [[] for _ in sentences]
    if not long:
        return cuts
    lengths = np.array([len(sentences[k]) for k in long])
    words = " ".join(chain.from_iterable(sentences[k] for k in long)).encode("utf-8", "surrogatepass").split(b" ")
    hashes = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    value = hashes.copy()
    value[1:] += hashes[:-1] * np.uint64(0x9E3779B97F4A7C15)
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(32)
    begin = np.cumsum(lengths) - lengths
    at = np.arange(len(words)) - np.repeat(begin, lengths)
    left = np.repeat(lengths, lengths) - at
    # The pair of a first word reaches into another sentence.
    value[begin] = np.iinfo(np.uint64).max
    least = (at >= min_words) & (left >= min_words)
    for step in range(1, min_words):
        # A place has min_words words of its sentence on both sides, so no other sentence is read.
        least[step:] &= value[step:] < value[:-step]
        least[:-step] &= value[:-step] <= value[step:]
    found = np.flatnonzero(least)
    owner = np.searchsorted(begin, found, "right") - 1
    for k, place in zip(owner.tolist(), (found - begin[owner]).tolist()):
        cuts[long[k]].append(place)
    for k in long:
        gaps = pairwise([0, *cuts[k], len(sentences[k])])
        more = [c for a, b in gaps if b - a > 4 * min_words > 0 for c in range(a + 2 * min_words, b - min_words + 1, 2 * min_words)]
        if more:
            cuts[k] = sorted(cuts[k] + more)
    return cuts


def units(text: str, min_words: int = MIN_WORDS) -> Iterator[tuple[bytes, int, int, int]]:
    """(digest, start, end, words) of every unit with a word; offsets in code points."""
    matches, sentences = [], []
    for match in UNIT.finditer(text):
        words = match[0].lower().split()
        if words:
            matches.append(match)
            sentences.append(words)
    tail: list[str] = []
    for match, sentence, cuts in zip(matches, sentences, places(sentences, min_words)):
        start = match.start() + len(match[0]) - len(match[0].lstrip())
        end = match.end() - (len(match[0]) - len(match[0].rstrip()))
        pieces = [(sentence, start, end)]
        if cuts:
            spans = [(match.start() + m.start(), match.start() + m.end()) for m in WORD.finditer(match[0])]
            pieces = [(sentence[a:b], spans[a][0], spans[b - 1][1]) for a, b in pairwise([0, *cuts, len(sentence)])]
        for words, start, end in pieces:
            tail = (tail + words)[-max(min_words, len(words)) :]
            key = " ".join(tail) if len(words) >= min_words else f"{len(words)}\n{' '.join(tail)}"
            tail = tail[-min_words:]
            yield hashlib.blake2b(key.encode("utf-8", "surrogatepass"), digest_size=16).digest(), start, end, len(words)


SCHEMA = "digest binary, doc_id long, start int, end int, words int, again boolean"


def unit_rows(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per unit; ``again`` marks units the document had further up."""

    def run(batches):
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [], [], [])
            held = 0
            for doc_id, text in zip(batch["doc_id"].to_pylist(), texts_of(batch["text"])):
                seen = set()
                for digest, start, end, words in units(text or "", min_words):
                    for column, value in zip(columns, (digest, doc_id, start, end, words, digest in seen)):
                        column.append(value)
                    seen.add(digest)
                held += len(text or "")
                if held > 4_000_000:
                    yield _batch(columns)
                    columns, held = ([], [], [], [], [], []), 0
            yield _batch(columns)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def _batch(columns) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_())
    names = ["digest", "doc_id", "start", "end", "words", "again"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def removals(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, start, end, words, keep_id) of every unit that goes."""
    rows = scratch_table(unit_rows(documents, min_words), "units")
    first = rows.where("NOT again")
    several = (
        first.groupBy("digest")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("documents"))
        .where(F.col("documents") > 1)
        .select("digest", "keep_id")
    )
    # One join: a hot digest is on its left side, where its partition can be split.
    named = rows.join(scratch_table(several, "repeated"), "digest", "left")
    # A repeat within one document goes wherever the kept occurrence is.
    gone = F.col("again") | (F.col("keep_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return named.where(gone).select("doc_id", "start", "end", "words", F.coalesce("keep_id", "doc_id").alias("keep_id"))


def passages(removed: DataFrame, gap: int = 3) -> DataFrame:
    """Removed units that touch, or are at most ``gap`` characters apart, as one span per document."""
    spans = F.array_sort(F.collect_list(F.struct("start", "end", "words", "keep_id")))
    grouped = removed.groupBy("doc_id").agg(spans.alias("spans"))
    empty = F.array().cast("array<struct<start:int,end:int,words:int,keep_id:bigint>>")

    def step(acc, s):
        last = F.element_at(acc, -1)
        joins = (F.size(acc) > 0) & (F.coalesce(F.try_element_at(acc, F.lit(-1))["end"], F.lit(-(1 << 30))) + gap >= s["start"])
        merged = F.struct(last["start"].alias("start"), s["end"].alias("end"), (last["words"] + s["words"]).alias("words"), last["keep_id"].alias("keep_id"))
        return F.when(joins, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(merged))).otherwise(F.concat(acc, F.array(s)))

    return grouped.select("doc_id", F.explode(F.aggregate("spans", empty, step)).alias("span")).select("doc_id", "span.*")


def without_removed(documents: DataFrame, removed: DataFrame) -> DataFrame:
    """The documents with their removed units cut out of the text."""
    cuts = removed.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    kept = F.aggregate(
        "cuts",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, c: F.struct(c["end"].alias("at"), F.concat(acc["out"], F.substring("text", acc["at"] + 1, c["start"] - acc["at"])).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring("text", acc["at"] + 1, F.length("text"))),
    )
    joined = documents.join(cuts, "doc_id", "left")
    return joined.withColumn("text", F.when(F.col("cuts").isNull(), F.col("text")).otherwise(kept)).drop("cuts")
