"""Packing, resampling and manifest against plain versions on the shared tables, and hard rows."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyloom.llm import importance, merkle, packing
from tallyloom.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import connect, difference

FOLDER = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
LONG = "wide words " * 6000
HARD = [
    (1, None), (2, ""), (3, " \t\n"), (3, "Same id"), (4, LONG), (5, LONG), (5, LONG), (6, "É日本 don't x1y"), (7, "<|endoftext|> a"),
    (None, "no id"), (None, "no id"), (8, "a" * 5000), (9, "line sep nbsp\x1cfs"),
]


@pytest.fixture(scope="module")
def hard(spark):
    rows = [(i, t, "z", 1, True, 2.5, 9) for i, t in HARD]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, part int, taker boolean, weight double, piece int")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


# --- packing ----------------------------------------------------------------------


def _plain_pieces(tokenizer, rows, capacity):
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), capacity):
            part = np.array(ids[k : k + capacity], dtype="<u4")
            yield doc_id, k // capacity, k, len(part), zlib.crc32(part.tobytes())


def _key(rows):
    return sorted(map(tuple, rows), key=repr)


def _best_fit(lengths, capacity):
    """Number of sequences that best fit decreasing opens."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, k) for k, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


def _check_layout(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_query(spark, tokenizer):
    got = QUERIES["op11_best_fit_packing"](spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = _key(_plain_pieces(tokenizer, docs, 2048))
    assert _key((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    opened = _check_layout(got, 2048)
    assert opened <= math.ceil(_best_fit([r[3] for r in want], 2048) * 1.01)


@pytest.mark.parametrize("name,lengths", [
    ("tiny", random.Random(1).choices(range(1, 10), k=6000)),
    ("short", random.Random(2).choices(range(1, 201), k=2000)),
    ("even", random.Random(3).choices(range(1, 2049), k=1500)),
    ("equal", [3] * 5000 + [700] * 100),
    ("exact", [1024] * 300 + [512] * 300 + [256] * 600),
])
def test_packing_is_near_best_fit(spark, name, lengths):
    pieces = spark.createDataFrame([(k, n) for k, n in enumerate(lengths)], "row long, length long")
    placed = {r.row: r.sequence for r in packing.place(pieces).collect()}
    assert len(placed) == len(lengths)
    sums = {}
    for row, sequence in placed.items():
        sums[sequence] = sums.get(sequence, 0) + lengths[row]
    assert max(sums.values()) <= 2048
    assert len(sums) <= math.ceil(_best_fit(lengths, 2048) * 1.03)


def test_packing_hard_rows(spark, hard, tokenizer):
    packed = packing.pack(packing.token_pieces(hard, capacity=256, with_ids=True), capacity=256)
    rows = packed.collect()
    assert _key((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == _key(_plain_pieces(tokenizer, HARD, 256))
    _check_layout(rows, 256)
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in rows:
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids
    assert packing.pack(packing.token_pieces(hard.limit(0))).count() == 0


def test_words_are_coded_once(tokenizer):
    """Words longer than the cache bound, repeated words and white space of all kinds."""
    coder = packing.Coder(tokenizer, {})
    texts = ["a b a", None, "", "x" * 500 + " a", " a b\x1cc\v\fd", "I'm it's 'll don't", "tab\tnew\nline"]
    for _ in range(2):
        ids, sizes = coder.code(pa.array(texts))
        want = [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]
        assert ids.tolist() == [i for one in want for i in one] and sizes.tolist() == list(map(len, want))
    assert "x" * 500 not in coder.known


# --- resampling ---------------------------------------------------------------------


def _plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def test_letter_words_go_to_the_model_alone(tokenizer):
    """Words of letters and trailing punctuation give the ids the tokenizer gives, without its text steps."""
    rng = random.Random(11)
    kinds = ("abcdefghijklmnopqrstuvwxyz", "abcßàéêñöøüÿþæ", "ABCéÉÀÿŸİıſΣσςъЪ中한가ªº×÷µ", "abc'", "ab1²", "ae\u0301\u0308", "a\u200d\u00ad")
    ends = ("", ".", ",###", "'", "''", "'s", "&&&", "[]^_`", "\\-/", "<", "|>", "...!?", "-x", "\u2019", "»")
    words = ["".join(rng.choices(rng.choice(kinds), k=rng.randint(1, 9))) + rng.choice(ends) for _ in range(6000)]
    words += [chr(c) for c in range(33, 0x250) if not chr(c).isspace()] + [f"a{chr(c)}b" for c in range(33, 0x250) if not chr(c).isspace()]
    coder = packing.Coder(tokenizer, {})
    ids, sizes = coder.code(pa.array(words, pa.string()))
    cuts = np.cumsum(sizes)
    got = [part.tolist() for part in np.split(ids, cuts[:-1])]
    want = [[*tokenizer.encode(w, add_special_tokens=False).ids, packing.END] for w in words]
    wrong = [(w, g, x) for w, g, x in zip(words, got, want) if g != x]
    assert not wrong, wrong[:5]
    texts = []

    class Counted:
        model = tokenizer.model

        def encode(self, text, **rest):
            texts.append(text)
            return tokenizer.encode(text, **rest)

    packing.Coder(Counted(), {}).code(pa.array(["straße señor", "wort### wort,"], pa.string()))
    # The mark, and the closing marks.
    assert all(t == packing.MARK or not any(c.isalpha() for c in t) for t in texts)


def test_crc_from_prefixes():
    texts = ["One two, THREE", "", "É-日本 x" * 50, "a" * 70000 + " b", "same same same"]
    scanned = importance.scan([t.encode() for t in texts])
    for n in (1, 2, 3):
        crcs, owner = scanned.ngrams(n)
        want = []
        for k, t in enumerate(texts):
            words = _plain_features(t)[0]
            want += [(k, zlib.crc32(" ".join(words[i : i + n]).encode())) for i in range(len(words) - n + 1)]
        assert list(zip(owner.tolist(), crcs.tolist())) == want


@pytest.mark.parametrize("name", ["op12_importance_resampling", "op13_merkle_manifest"])
def test_against_sql(spark, name):
    for folder in (SMALL, FOLDER):
        assert difference(QUERIES[name](spark, folder), connect(folder), ORACLE_SQL[name]) is None


def _plain_resample(rows, target, min_words, percent):
    s, t = [0] * 10000, [0] * 10000
    for side, texts in ((s, [r[1] for r in rows]), (t, target)):
        for text in texts:
            for f in _plain_features(text)[1]:
                side[zlib.crc32(f.encode()) % 10000] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10000) / ((a + 1) * (sum(t) + 10000)))) for a, b in zip(s, t)]
    out = []
    for doc_id, text in rows:
        words, found = _plain_features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % 10000] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    able = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = [r[:4] + (k + 1,) for k, r in enumerate(able[: len(able) * percent // 100])]
    rest = [r[:4] + (None,) for r in able[len(able) * percent // 100 :] + [r for r in out if r[4] < min_words]]
    return _key(drawn + rest)


def test_resampling_hard_rows(spark, hard):
    target = spark.createDataFrame([(0, "wide words don't"), (1, None)], "item_id long, text string")
    got = importance.resample(hard, target, min_words=2, percent=50)
    assert _key(got.collect()) == _plain_resample(HARD, ["wide words don't", None], 2, 50)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert importance.resample(hard.limit(0), target).count() == 0
    assert importance.resample(hard, target.limit(0)).count() == len(HARD)


# --- manifest -----------------------------------------------------------------------


def _leaf(values):
    return hashlib.sha256("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values).encode()).hexdigest()


def _climb(nodes, at):
    """(root, siblings of the node at a place, level by level)."""
    path = []
    while len(nodes) > 1:
        first = at - at % 8
        path.append((nodes[first:at], nodes[at + 1 : first + 8]))
        nodes, at = [merkle.digest(nodes[k : k + 8]) for k in range(0, len(nodes), 8)], at // 8
    return nodes[0], path


@pytest.mark.parametrize("sizes,levels", [((1,), 4), ((9, 1), 1), ((8, 64, 65), 1), ((513, 70, 3), 1), ((600,), 2), ((1000, 64, 9, 1, 2, 3, 4, 5, 6), 1)])
def test_butterfly_agrees_with_one_tree(spark, sizes, levels):
    """Small blocks, so that several rounds and ragged last subtrees occur."""
    rows = [(f"b{b}", k, hashlib.sha256(f"{b}/{k}".encode()).hexdigest(), None) for b, n in enumerate(sizes) for k in range(n)]
    branches = {}
    for branch, _, leaf, _ in rows:
        branches.setdefault(branch, []).append(leaf)
    tops = [_climb(branches[b], 0)[0] for b in sorted(branches)]
    shuffled = random.Random(7).sample(rows, len(rows))
    leaves = spark.createDataFrame(shuffled, "branch string, id long, leaf string, claimed string").repartition(5)
    made = merkle.manifest(leaves, levels)
    found = {(r.branch, r.block): r for r in made.upper.collect()}
    for b, branch in enumerate(sorted(branches)):
        for at in range(0, len(branches[branch]), 8**levels):
            row = found[branch, at // 8**levels]
            subroot, path = _climb(branches[branch], at)
            root, above = _climb(tops, b)
            want = path[levels:] + above
            assert (row.subroot, row.top) == (subroot, root)
            assert [(s.left, s.right) for s in row.path] == [("".join(x), "".join(y)) for x, y in want]


def test_manifest_hard_rows(spark):
    rows = [
        (1, "s", "en", 3, "Abc"), (2, None, None, None, None), (2, "", "", 0, ""), (3, "s", None, 1, "É日本"), (3, "s", None, 1, "É日本"),
        (None, "s", "en", 2, "No"), (-5, "s", "en", 9, "X" * 100000), (4, "s", "=", 1, "-"),
    ]
    docs = spark.createDataFrame([(*r, "z", 0, "y") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf string, block int, branch string")
    got = merkle.manifest(merkle.leaves(docs, merkle.tampered(docs))).proofs().collect()
    groups = {}
    for r in rows:
        groups.setdefault("" if r[2] is None else "=" + r[2], []).append(((r[0] is not None, r[0] or 0), _leaf(r), r))
    tops = []
    for g in sorted(groups):
        groups[g].sort()
        tops.append(_climb([x[1] for x in groups[g]], 0)[0])
    want = []
    for b, g in enumerate(sorted(groups)):
        nodes = [x[1] for x in groups[g]]
        for at, (_, leaf, r) in enumerate(groups[g]):
            path = _climb(nodes, at)[1] + _climb(tops, b)[1]
            touched = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None
            shown = _leaf((*r[:4], re.sub("[A-Z]", lambda m: m.group().lower(), r[4]))) if touched else leaf
            want.append((None if r[0] is None else str(r[0]), leaf, tops[b], merkle.fold(shown, [("".join(x), "".join(y)) for x, y in path])))
    root = _climb(tops, 0)[0]
    assert _key((r.id, r.leaf, r.subroot, r.folded) for r in got) == _key(want)
    assert {r.root for r in got} == {root}
    for r in got:
        assert merkle.fold(r.leaf, [(s.left, s.right) for s in r.proof]) == root
    assert merkle.manifest(merkle.leaves(docs.limit(0))).checks().count() == 0
