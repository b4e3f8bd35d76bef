"""Benchmark decontamination by latent semantic retrieval.

Words of the benchmark are the vocabulary. Documents are coded once, each word
as its place in the vocabulary; document frequencies are counted over all of
them. The TF-IDF matrix of all passages (windows of the documents and of the
benchmark items) is never formed: a randomised range finder multiplies it, and
its transpose, with a narrow random matrix in every task, and only these sums
meet. Their Nystroem form gives the leading singular vectors.

Windows of every document, about as long as the items they are held against,
are projected and compared with all items by cosine, in blocks. A candidate is
verified in the same task, on the words around the window: the longest common
subsequence of content words with the item, and whether the answer of the item
is there too.

Defined results: null and empty texts and items match nothing; rows that share
an id are reported each; an item is reported once for each document row, at its
best place; an empty table on either side gives no rows; other columns of the
inputs are ignored, but for an optional ``answer`` of the benchmark.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shingles import hashes_of, pieces, small_batches, word_hashes
from tallyloom.session import scratch_table

RANK, EXTRA = 64, 16
SMALLEST, LARGEST = 8, 64
CANDIDATE = 0.36
# Share of an item's content words, in order, that makes a leak; the lower one needs the answer too.
LEAK, LEAK_WITH_ANSWER = 0.7, 0.5
ANSWER_WORDS, ANSWER_SHARE = 5, 0.8
# Words in more than this share of all documents are no content words.
COMMON = 0.2
# Words of the benchmark that are searched for at a time.
BLOCK_WORDS = 2_000_000
# Sums of so many lanes of tasks are added apart before the rest.
LANES = 64


@dataclass(frozen=True)
class Items:
    """The benchmark, or a block of it, coded by the vocabulary of all of it (sorted word hashes)."""

    ids: list
    vocabulary: np.ndarray
    codes: list
    answers: list
    words: pa.Array | None = None

    def blocks(self, words: int) -> list["Items"]:
        """The items in blocks of about so many words each, in their order."""
        sizes = np.cumsum([len(c) for c in self.codes])
        cut = [*np.unique((sizes - 1) // words, return_index=True)[1], len(self.ids)]
        return [Items(self.ids[a:b], self.vocabulary, self.codes[a:b], self.answers[a:b]) for a, b in zip(cut, cut[1:])]


def items_of(benchmark: DataFrame) -> Items:
    columns = ["item_id", "text", *(["answer"] if "answer" in benchmark.columns else [])]
    rows = [r for r in benchmark.select(*columns).orderBy("item_id", "text").collect() if r.text and r.text.strip()]
    hashes, owner = word_hashes(pa.array([r.text for r in rows], pa.string()))
    vocabulary = np.unique(hashes)
    codes = np.searchsorted(vocabulary, hashes)
    split = [codes[owner == k] for k in range(len(rows))]
    answers = []
    for row, own in zip(rows, split):
        given = getattr(row, "answer", None)
        answers.append(own[-ANSWER_WORDS:] if not given else code(vocabulary, word_hashes(pa.array([given]))[0]))
    return Items([r.item_id for r in rows], vocabulary, split, answers, words_of([r.text for r in rows], vocabulary))


def code(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each word in the vocabulary; its length stands for all other words."""
    at = np.searchsorted(vocabulary, hashes)
    at[at == len(vocabulary)] = 0
    return np.where(vocabulary[at] == hashes, at, len(vocabulary)).astype(np.int64)


def width(words: int) -> int:
    """Window that an item of so many words is compared with."""
    return int(np.clip(2 ** round(np.log2(max(words, 1))), SMALLEST, LARGEST))


def words_of(benchmark: list[str], vocabulary: np.ndarray) -> pa.Array:
    """The words behind the hashes of a vocabulary, in its order."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(benchmark, pa.string()))).flatten().unique()
    named = dict(zip(hashes_of(words).tolist(), words.to_pylist()))
    return pa.array([named[h] for h in vocabulary.tolist()], pa.string())


def word_codes(texts: pa.Array, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(place of every word among ``words``, their number for others; text each word is of)."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    owner = pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
    found = split.flatten().dictionary_encode()
    place = pc.fill_null(pc.index_in(found.dictionary, value_set=words), len(words)).to_numpy(zero_copy_only=False)
    blank = pc.equal(found.dictionary, "").to_numpy(zero_copy_only=False)
    indices = found.indices.to_numpy(zero_copy_only=False)
    keep = ~blank[indices] if len(blank) else np.zeros(0, dtype=bool)
    return place[indices[keep]] if len(blank) else np.zeros(0, np.int64), owner[keep].astype(np.int64)


def coded(documents: DataFrame, words: pa.Array) -> DataFrame:
    """(doc_id, codes) of every document that has a word, codes packed."""
    kind = np.uint16 if len(words) < 65535 else np.uint32
    shared = documents.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                codes, owner = word_codes(piece["text"], shared.value)
                ends = np.cumsum(np.bincount(owner, minlength=piece.num_rows))
                packed = [c.tobytes() for c in np.split(codes.astype(kind), ends[:-1])] if piece.num_rows else []
                yield pa.RecordBatch.from_arrays([piece["doc_id"], pa.array(packed, pa.binary())], names=["doc_id", "codes"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, codes binary")


def _codes(batch, size: int):
    kind = np.uint16 if size < 65535 else np.uint32
    return [np.frombuffer(x.as_buffer(), dtype=kind).astype(np.int64) for x in batch["codes"]]


def frequencies(rows: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """(documents with each word, number of documents): one row per word and task is shuffled."""

    def run(batches):
        seen, documents = np.zeros(size + 1, dtype=np.int64), 0
        for batch in batches:
            for codes in _codes(batch, size):
                seen[np.unique(codes)] += 1
            documents += batch.num_rows
        seen[size] = documents
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], names=["code", "documents"])

    out = np.zeros(size + 1, dtype=np.int64)
    for row in rows.mapInArrow(run, "code long, documents long").groupBy("code").agg(F.sum("documents").alias("n")).collect():
        out[row.code] = row.n
    return out[:size], int(out[size])


def _windows(codes: np.ndarray, length: int) -> list[np.ndarray]:
    return [codes[k : k + length] for k in range(0, max(1, len(codes)), length)]


# Rows of one sum that are added before their sums are.
RUN = 32


def segment_sums(table: np.ndarray, rows: np.ndarray, begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of ``table[rows[b : b + n]]`` for each segment (b, n), n at least 1.

    The first rows of all segments are added at once, then the second ones, and
    so on, with the segments in order of their length: whole rows at a time,
    which ``add.reduceat`` does value by value.
    """
    if not len(counts):
        return np.zeros((0, table.shape[1]), dtype=table.dtype)
    if counts.max() > RUN:
        parts = -(-counts // RUN)
        first = np.cumsum(parts) - parts
        place = np.arange(parts.sum()) - np.repeat(first, parts)
        sums = segment_sums(table, rows, np.repeat(begin, parts) + place * RUN, np.minimum(np.repeat(counts, parts) - place * RUN, RUN))
        return segment_sums(sums, np.arange(len(sums)), first, parts)
    order = np.argsort((RUN - counts).astype(np.uint8), kind="stable")
    longer = len(counts) - np.cumsum(np.bincount(counts, minlength=RUN + 1))
    at, out = begin[order], np.empty((len(counts), table.shape[1]), dtype=table.dtype)
    for a in range(0, len(order), 8192):
        own = at[a : a + 8192]
        total = table[rows[own]]
        for k in range(1, RUN):
            n = min(longer[k] - a, len(own))
            if n <= 0:
                break
            total[:n] += table[rows[own[:n] + k]]
        out[order[a : a + 8192]] = total
    return out


def _gram_times(windows: list[np.ndarray], weights: np.ndarray, omega: np.ndarray) -> np.ndarray:
    """Sum over windows of x (x' omega) for unit TF-IDF vectors x, without forming them.

    A word that a window repeats adds its weight each time; words outside the
    vocabulary only count for the length of a vector.
    """
    size = len(weights) - 1
    out = np.zeros(omega.shape, dtype=np.float32)
    flat = np.concatenate(windows)
    lengths = np.array([len(w) for w in windows])
    begin = np.cumsum(lengths) - lengths
    norm = np.sqrt(np.add.reduceat(weights[flat] ** 2, begin))
    window = np.repeat(np.arange(len(windows)), lengths)
    known = flat < size
    flat, window = flat[known], window[known]
    if not len(flat):
        return out
    new = np.append(True, window[1:] != window[:-1])
    begin = np.flatnonzero(new)
    # A word weighs the same in every window; the length of the window divides both factors.
    share = (1 / np.maximum(norm[window[begin]], 1e-12) ** 2).astype(np.float32)
    words, own = np.unique(flat, return_inverse=True)
    weight = weights[words].astype(np.float32)[:, None]
    sums = segment_sums(omega[words] * weight, own, begin, np.diff(np.append(begin, len(flat)))) * share[:, None]
    order = np.argsort(flat.astype(np.uint16) if size < 65535 else flat, kind="stable")
    counts = np.bincount(own)
    out[words] = segment_sums(sums, (np.cumsum(new) - 1)[order], np.cumsum(counts) - counts, counts) * weight
    return out


def singular_vectors(rows: DataFrame, items: Items, weights: np.ndarray, rank: int = RANK, extra: int = EXTRA, seed: int = 7) -> np.ndarray:
    """Leading right singular vectors of the TF-IDF passages, (vocabulary, rank)."""
    size = len(items.vocabulary)
    narrow = min(rank + extra, size)
    omega = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, narrow)))[0].astype(np.float32)
    shared = rows.sparkSession.sparkContext.broadcast((weights, omega))

    def run(batches):
        weights, omega = shared.value
        total = np.zeros((size, narrow))
        for batch in batches:
            held, words = [], 0
            for codes in _codes(batch, size):
                held += [w for w in _windows(codes, 32) if len(w)]
                words += len(codes)
                if words > 50_000:
                    total += _gram_times(held, weights, omega)
                    held, words = [], 0
            if held:
                total += _gram_times(held, weights, omega)
        # The sum of a task travels in slices of rows, which are added apart: in
        # lanes of some tasks first, so that no group holds a row of every task.
        lane = TaskContext.get().partitionId() % LANES
        for start in range(0, size, 256):
            yield pa.RecordBatch.from_arrays(
                [pa.array([start]), pa.array([lane]), pa.array([total[start : start + 256].ravel()], pa.list_(pa.float64()))], names=["start", "lane", "values"]
            )

    def add(table):
        values = table["values"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        return pa.table({"start": table["start"][:1], "lane": table["lane"][:1], "values": pa.array([values.sum(axis=0)], pa.list_(pa.float64()))})

    slices = "start long, lane long, values array<double>"
    sums = rows.mapInArrow(run, slices).groupBy("start", "lane").applyInArrow(add, slices).groupBy("start").applyInArrow(add, slices)
    image = _gram_times([w for c in items.codes for w in _windows(c, 32)], weights, omega).astype(np.float64)
    added = sums.collect()
    shared.destroy()
    for row in added:
        block = np.array(row["values"]).reshape(-1, narrow)
        image[row.start : row.start + len(block)] += block
    # Nystroem: image (omega' image)^-1 image' stands for the whole product.
    core = omega.T @ image
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    keep = values > values.max() * 1e-9
    left, strength, _ = np.linalg.svd(image @ (vectors[:, keep] / np.sqrt(values[keep])), full_matrices=False)
    return left[:, : min(rank, len(strength))].astype(np.float32)


def subsequence(item: np.ndarray, region: np.ndarray) -> int:
    """Length of the longest common subsequence, a bit per word of the item."""
    masks: dict[int, int] = {}
    for k, word in enumerate(item.tolist()):
        masks[word] = masks.get(word, 0) | (1 << k)
    row = 0
    for word in region.tolist():
        mask = masks.get(word)
        if mask:
            joined = row | mask
            row = joined & ~(joined - ((row << 1) | 1))
    return row.bit_count()


@dataclass(frozen=True)
class Searcher:
    """What a task needs to search a document for the items."""

    items: Items
    basis: np.ndarray
    weights: np.ndarray
    content: np.ndarray
    candidate: float

    def prepared(self):
        """Per window width: items and their unit vectors."""
        by_width: dict[int, list[int]] = {}
        for k, codes in enumerate(self.items.codes):
            by_width.setdefault(width(len(codes)), []).append(k)
        vectors = np.zeros((len(self.items.codes), self.basis.shape[1]), dtype=np.float32)
        for k, codes in enumerate(self.items.codes):
            vectors[k] = (self.weights[codes, None] * self.basis[codes]).sum(axis=0)
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        size = len(self.items.vocabulary)
        table = (self.basis * self.weights[:size, None]).astype(np.float32)
        return {w: (np.array(ks), vectors[ks].T.copy()) for w, ks in sorted(by_width.items())}, table, [c[self.content[c]] for c in self.items.codes]

    def windows(self, documents: list[np.ndarray], table: np.ndarray, widths: list[int]):
        """(width, document, start, similarity vectors) of all windows, half a width apart."""
        lengths = np.array([len(d) for d in documents])
        flat = np.concatenate(documents) if len(documents) else np.zeros(0, dtype=np.int64)
        base = min(widths) // 2
        counts = -(-lengths // base)
        owner = np.repeat(np.arange(len(documents)), counts)
        step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = np.repeat(np.cumsum(lengths) - lengths, counts) + step * base
        sums = np.zeros((len(starts), table.shape[1]), dtype=np.float32)
        mass = np.empty((len(starts), 2), dtype=np.float32)
        square = self.weights**2
        known = np.append(square[:-1], 0.0)
        for a in range(0, len(starts), 8192):
            b = min(a + 8192, len(starts))
            end = starts[b] if b < len(starts) else len(flat)
            part, at = flat[starts[a] : end], starts[a:b] - starts[a]
            # Words outside the vocabulary have no vector.
            inside = np.flatnonzero(part < len(table))
            if len(inside):
                row = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(part))))[inside]
                new = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                sums[a + row[new]] = segment_sums(table, part[inside], new, np.diff(np.append(new, len(inside))))
            mass[a:b, 0] = np.add.reduceat(known[part], at)
            mass[a:b, 1] = np.add.reduceat(square[part], at)
        for w in widths:
            while base < w // 2:
                # Two neighbouring blocks of a document make one of the next size.
                even = step % 2 == 0
                pairs = np.flatnonzero(even)
                after, to = np.flatnonzero(~even), (np.cumsum(even) - 1)[~even]
                more, mass_more = sums[after], mass[after]
                sums, mass = sums[pairs], mass[pairs]
                sums[to] += more
                mass[to] += mass_more
                owner, step, base = owner[pairs], step[pairs] // 2, base * 2
            follows = np.append(owner[1:] == owner[:-1], False)
            first = step == 0
            use = np.flatnonzero(follows | first)
            after = np.minimum(use + 1, len(sums) - 1)
            joined = sums[use] + np.where(follows[use, None], sums[after], 0)
            weight = mass[use] + np.where(follows[use, None], mass[after], 0)
            norm = np.linalg.norm(joined, axis=1)
            # Words outside the vocabulary lessen the similarity by their share of the weight.
            share = np.sqrt(weight[:, 0] / np.maximum(weight[:, 1], 1e-9))
            joined *= (share / np.maximum(norm, 1e-9))[:, None]
            yield w, owner[use], step[use] * base, joined

    def search(self, documents: list[np.ndarray], prepared):
        """(document, item, start, end, subsequence, ratio, similarity, answer) of every leak."""
        vectors, table, words = prepared
        seen = np.zeros(len(self.items.vocabulary) + 1, dtype=bool)
        best: dict[tuple[int, int], tuple] = {}
        for w, owner, start, joined in self.windows(documents, table, list(vectors)):
            ks, items = vectors[w]
            rows = max(1, 4_000_000 // len(ks))
            for a in range(0, len(joined), rows):
                likeness = joined[a : a + rows] @ items
                r, c = np.nonzero(likeness >= self.candidate)
                for d, k, r, c in self.possible(documents, owner[a + r], ks[c], r, c, words, seen):
                    found = self.verified(documents[d], int(start[a + r]), w, k, words, seen)
                    if found and found[3] > best.get((d, k), (0, 0, 0, 0.0))[3]:
                        best[d, k] = (*found, float(likeness[r, c]))
        return [(d, k, *v) for (d, k), v in sorted(best.items())]

    def compared(self, k: int, prepared_words: list) -> np.ndarray:
        """Words of an item that are looked for: all of them where few are content words."""
        return prepared_words[k] if len(prepared_words[k]) >= 4 else self.items.codes[k]

    def possible(self, documents: list[np.ndarray], owner: np.ndarray, item: np.ndarray, r: np.ndarray, c: np.ndarray, words: list, seen: np.ndarray):
        """Candidates (document, item, row, column) whose document, as a whole, holds enough words of the item.

        Candidates come by document, many windows and items for each; its words
        are marked once for all of them.
        """
        edges = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, dtype=np.int64)
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(owner)]):
            d = int(owner[a])
            held = documents[d]
            seen[held] = True
            enough = {}
            for k in set(item[a:b].tolist()):
                wanted = self.compared(k, words)
                enough[k] = np.count_nonzero(seen[wanted]) >= LEAK_WITH_ANSWER * len(wanted)
            seen[held] = False
            for k, row, column in zip(item[a:b].tolist(), r[a:b].tolist(), c[a:b].tolist()):
                if enough[k]:
                    yield d, k, row, column

    def verified(self, document: np.ndarray, start: int, w: int, k: int, prepared_words: list, seen: np.ndarray):
        item = self.items.codes[k]
        a, b = max(0, start - len(item)), min(len(document), start + w + len(item))
        region = document[a:b]
        words = self.compared(k, prepared_words)
        # Words of the item that are there at all bound what can be in order.
        total = len(words)
        seen[region] = True
        there = np.count_nonzero(seen[words])
        seen[region] = False
        if there < LEAK_WITH_ANSWER * total:
            return None
        held = region if words is item else region[self.content[region]]
        common = subsequence(words, held)
        ratio = common / total
        if ratio < LEAK_WITH_ANSWER:
            return None
        answer = self.items.answers[k]
        has_answer = len(answer) > 0 and subsequence(answer, region) >= ANSWER_SHARE * len(answer)
        if ratio < LEAK and not has_answer:
            return None
        return a, b, common, ratio, has_answer


RESULT = "doc_id long, item_id long, start_word long, end_word long, common long, ratio double, has_answer boolean, similarity double"


def leaks(documents: DataFrame, benchmark: DataFrame, candidate: float = CANDIDATE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, start_word, end_word, common, ratio, has_answer, similarity) of every leak.

    Vocabulary, weights and basis are those of the whole benchmark; only the
    search takes its items in blocks, so candidates do not depend on the blocks.
    """
    spark, items = documents.sparkSession, items_of(benchmark)
    size = len(items.vocabulary)
    if not size:
        return spark.createDataFrame([], RESULT)
    small_batches(spark)
    rows = scratch_table(coded(documents, items.words), "coded")
    seen, total = frequencies(rows, size)
    inverse = np.log((total + 1) / (seen + 1)) + 1e-3
    weights = np.append(inverse, np.median(inverse))
    basis = singular_vectors(rows, items, weights)
    content = np.append(seen <= COMMON * total, False)
    found = []
    for block in items.blocks(block_words):
        shared = spark.sparkContext.broadcast(Searcher(block, basis, weights.astype(np.float32), content, candidate))
        found.append(scratch_table(rows.mapInArrow(_searched(shared, size), RESULT), "leaks"))
        shared.destroy()
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _searched(shared, size: int):
    def run(batches):
        searcher = shared.value
        prepared = searcher.prepared()
        for batch in batches:
            codes, ids = _codes(batch, size), batch["doc_id"].to_pylist()
            start, words = 0, 0
            for k, document in enumerate(codes):
                words += len(document)
                if words > 200_000 or k == len(codes) - 1:
                    kept = [n for n in range(start, k + 1) if len(codes[n])]
                    found = searcher.search([codes[n] for n in kept], prepared) if kept else []
                    yield _table([(ids[kept[d]], searcher.items.ids[i], *rest) for d, i, *rest in found])
                    start, words = k + 1, 0

    return run


def _table(rows) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.float64())
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    names = [part.split()[0] for part in RESULT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
