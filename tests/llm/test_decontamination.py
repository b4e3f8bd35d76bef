"""Leaks against shared word runs, planted paraphrases and hard rows."""

import random

import numpy as np

from tallyloom.llm import decontamination as D
from tallyloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def _runs(documents, items, length=8):
    """(doc, item) pairs that share most of the item's runs of words."""
    grams = {}
    for item, text in items:
        words = text.lower().split()
        for k in range(len(words) - length + 1):
            grams.setdefault(tuple(words[k : k + length]), set()).add(item)
    size = {item: max(1, len(text.split()) - length + 1) for item, text in items}
    shared = {}
    for doc, text in documents:
        words = (text or "").lower().split()
        for gram in {tuple(words[k : k + length]) for k in range(len(words) - length + 1)}:
            for item in grams.get(gram, ()):
                shared[doc, item] = shared.get((doc, item), 0) + 1
    return {pair for pair, n in shared.items() if n >= 0.8 * size[pair[1]]}, set(shared)


def test_finds_planted_items(spark):
    read = lambda name, *c: [tuple(r) for r in spark.read.parquet(f"{FOLDER}/{name}.parquet").select(*c).collect()]
    whole, some = _runs(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    got = {(r.doc_id, r.item_id) for r in QUERIES["op6_decontamination"](spark, FOLDER).collect()}
    assert whole and len(whole & got) >= 0.95 * len(whole)
    assert len(got - some) <= 0.02 * len(got)


def _words(rng, n):
    return [f"w{int(3000 * rng.random() ** 2)}" for _ in range(n)]


def test_paraphrases_and_clean_texts(spark):
    rng = random.Random(3)
    items = [_words(rng, rng.randrange(15, 60)) for _ in range(60)]
    rows = []
    for i in range(400):
        text = _words(rng, rng.randrange(40, 400))
        if i % 4 == 0:
            item = [w if rng.random() > 0.15 else f"x{rng.randrange(9999)}" for w in items[i % 60]]
            at = rng.randrange(len(text))
            text[at:at] = item
        rows.append((i, " ".join(text), "c", 0.5))
    docs = spark.createDataFrame(rows, "doc_id long, text string, codes string, ratio double")
    bench = spark.createDataFrame([(k, " ".join(t), 1) for k, t in enumerate(items)], "item_id long, text string, doc_id int")
    got = {(r.doc_id, r.item_id) for r in D.leaks(docs, bench).collect()}
    planted = {(i, i % 60) for i in range(0, 400, 4)}
    assert len(got & planted) >= 0.9 * len(planted) and len(got - planted) <= 2


def test_hard_rows(spark):
    item = "the quick brown fox jumps over one lazy dog and then sleeps in a very warm den all day"
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, "x"), (4, item), (4, item), (5, f"{'pad ' * 50000}{item.upper()} {'pad ' * 50}"), (None, item)],
        "doc_id long, text string",
    )
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "  ")], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in D.leaks(docs, bench).collect()), key=str)
    assert got == [(4, 1), (4, 1), (5, 1), (None, 1)]
    assert D.leaks(docs.limit(0), bench).count() == 0
    assert D.leaks(docs, bench.limit(0)).count() == 0


def test_subsequence_matches_table():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = rng.integers(0, 6, rng.integers(0, 30)), rng.integers(0, 6, rng.integers(0, 60))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for k, y in enumerate(b):
                new.append(row[k] + 1 if x == y else max(new[-1], row[k + 1]))
            row = new
        assert D.subsequence(a, b) == row[-1]


def test_gram_product_matches_dense():
    rng = np.random.default_rng(4)
    weights = np.append(rng.random(30) + 0.1, 0.5)
    windows = [rng.integers(0, 31, rng.integers(1, 12)) for _ in range(40)]
    omega = rng.standard_normal((30, 5)).astype(np.float32)
    dense = np.zeros((40, 31))
    for k, w in enumerate(windows):
        np.add.at(dense[k], w, weights[w])
        dense[k] /= np.sqrt((weights[w] ** 2).sum())
    want = dense[:, :30].T @ (dense[:, :30] @ omega)
    assert np.allclose(D._gram_times(windows, weights, omega), want, atol=1e-4)


def _planted(rng, changed):
    items = [_words(rng, rng.randrange(15, 60)) for _ in range(40)]
    rows = []
    for i in range(300):
        text = _words(rng, rng.randrange(40, 300))
        if i % 3 == 0:
            at = rng.randrange(len(text))
            text[at:at] = [w if rng.random() > changed else f"x{rng.randrange(9999)}" for w in items[i % 40]]
        rows.append((i, " ".join(text)))
    return rows, [(k, " ".join(t)) for k, t in enumerate(items)]


def test_blocks_and_recall_against_all_windows(spark):
    """Blocks change nothing, and the cosine cut loses little of what all windows would give."""
    for changed in (0.1, 0.25):
        rows, items = _planted(random.Random(5), changed)
        docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
        one, three = (sorted(map(tuple, D.leaks(docs, bench, block_words=n).collect())) for n in (D.BLOCK_WORDS, 600))
        assert [r[:7] for r in one] == [r[:7] for r in three] and np.allclose([r[7] for r in one], [r[7] for r in three], atol=1e-4)
        every = {r[:2] for r in map(tuple, D.leaks(docs, bench, candidate=-2.0).collect())}
        assert every and len({r[:2] for r in one} & every) >= 0.9 * len(every)
