"""The n-gram join against all pairs on small tables."""

import random
import re

import pyarrow as pa
import pytest

from tallyloom.llm import ngram_join
from tallyloom.llm.components import components
from tallyloom.llm.queries import QUERIES
from tallyloom.llm.shingles import hashes_of

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = {}
    for doc_id, text in rows:
        sets.setdefault(doc_id, []).append(shingles(text))
    ids = sorted(sets)
    name = {i: i for i in ids}

    def find(i):
        while name[i] != i:
            i = name[i]
        return i

    holders = {}
    for i in ids:
        for s in set().union(*sets[i]):
            holders.setdefault(s, []).append(i)
    pairs = {(a, b) for h in holders.values() if len(h) > 1 for k, a in enumerate(h) for b in h[k + 1 :]}
    for a, b in pairs:
        if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
            x, y = sorted((find(a), find(b)))
            name[y] = x
    return {i: (max(map(len, sets[i])), find(i)) for i in ids}


def check(spark, rows):
    df = spark.createDataFrame([(*r, "n", 1) for r in rows], "doc_id long, text string, shingles string, n int")
    got = ngram_join.near_duplicates(df).collect()
    want = brute([r for r in rows if r[0] is not None])
    assert len(got) == len(rows)
    wrong = [(r, want[r.doc_id]) for r in got if r.doc_id is not None and (r.n_shingles, r.component_id) != want[r.doc_id]]
    assert not wrong, wrong[:5]


def test_shared_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op1_ngram_join"](spark, FOLDER).collect()}
    assert got == want


def test_hard_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "A b c d"), (5, "a b c D"), (6, "a b c d e"), (7, "a B c d e"), (8, "w " * 60000),
        (9, "w " * 5), (10, "x"), (10, "x"), (None, "x"), (11, "X"), (12, "a b c d e f"), (13, "q r s t u v w x y"), (14, "q r s t u v w x"),
        (15, "q r s t u v w"),
    ]
    check(spark, rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_edited_copies_and_common_passages(spark, seed):
    rng = random.Random(seed)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    passage, base, rows = words(60), words(150), []
    for i in range(900):
        kind = i % 6
        if kind == 0:
            text = words(rng.randrange(1, 300))
        elif kind == 1:
            text = words(rng.randrange(1, 60)) + passage + words(rng.randrange(1, 30))
        elif kind == 2:
            text = list(base)
            for _ in range(rng.randrange(0, 9)):
                text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
        elif kind == 3 and rows:
            text = rng.choice(rows)[1].split()
            for _ in range(max(1, len(text) // rng.choice((40, 60, 90)))):
                text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
        elif kind == 4 and rows:
            text = rng.choice(rows)[1].split()
            text = text[: int(len(text) * rng.choice((0.7, 0.74, 0.75, 0.76, 0.8, 0.95))) + 1]
        else:
            text = words(rng.randrange(1, 12))
        rows.append((i * 7 % 900, " ".join(text)))
    # 150 texts with one passage and 150 edits of one base: hot signatures and sets that fall short.
    check(spark, rows)


def test_raised_values_lose_nothing(spark, monkeypatch):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        text = rng.choice(rows)[1].split() if i % 2 and rows else [f"w{rng.randrange(400)}" for _ in range(rng.randrange(5, 120))]
        for _ in range(rng.randrange(0, 5)):
            text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    real = ngram_join.allocate

    def raised(scheme, seen, met, held):
        values = real(scheme, seen, met, held)
        values[::2], values[1::5] = 1, -1
        return values

    monkeypatch.setattr(ngram_join, "allocate", raised)
    check(spark, rows)


def test_allowed_difference_is_exact():
    for a in range(1, 60):
        for b in range(a, 60):
            fits = [d for d in range((b - a), a + b + 1) if (a + b - d) % 2 == 0 and 100 * (a + b - d) >= 75 * (a + b + d)]
            assert all(d <= ngram_join.allowed(a, b) for d in fits)
            assert not fits or b <= ngram_join.largest_partner(a)


def test_sketches_never_differ_more_than_sets():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(200):
        pool = rng.integers(0, 2**63, 400).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in range(2))
        x, y = sorted((np.frombuffer(ngram_join.parity_sketch(s), dtype=np.uint8) for s in (a, b)), key=len)
        while len(y) > len(x):
            y = y[: len(y) // 2] ^ y[len(y) // 2 :]
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100)] + [(500, i) for i in range(501, 700)] + [(800, 800), (900, 901), (902, 901)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(101)} == {0} and {got[i] for i in range(500, 700)} == {500} and got[902] == got[900] == 900
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_tell_words_apart():
    """Words of every length, also sliced arrays and ones that differ in one byte or in length only."""
    rng = random.Random(8)
    words = {"".join(rng.choices("abcé日", k=n)) for n in list(range(1, 40)) * 20} | {"x" * n for n in range(400)} | {"\0", "\0\0", "a\0", "é" * 200, "ab" * 300}
    listed = sorted(words)
    for kind in (pa.string(), pa.large_string()):
        got = hashes_of(pa.array(listed, kind))
        assert len(set(got.tolist())) == len(listed)
        assert (hashes_of(pa.array(listed, kind).slice(7, 50)) == got[7:57]).all()
    assert len(hashes_of(pa.array([], pa.string()))) == 0
