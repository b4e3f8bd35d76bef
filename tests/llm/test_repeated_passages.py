"""Removed units against repeated windows of 50 words, found without units()."""

import random
import re
from collections import defaultdict

from tallyloom.llm import line_dedup
from tallyloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
WINDOW = 50


def _runs(documents):
    """(doc, spans of the words) of every longest run of windows that an earlier document holds."""
    first, runs = {}, []
    for doc, text in sorted((d, t or "") for d, t in documents):
        spans = [m.span() for m in re.finditer(r"\S+", text)]
        words = [text[a:b].lower() for a, b in spans]
        windows = [hash(tuple(words[k : k + WINDOW])) for k in range(len(words) - WINDOW + 1)]
        open_ = None
        for k, window in enumerate(windows):
            if first.get(window, doc) == doc:
                continue
            if open_ and k <= open_[1]:
                open_[1] = k + WINDOW
            else:
                open_ = [k, k + WINDOW]
                runs.append((doc, spans, open_))
        for window in windows:
            first.setdefault(window, doc)
    return [(doc, spans[a:b]) for doc, spans, (a, b) in runs]


def _shares(documents, removed):
    """Share of the words of each run that removed units cover."""
    cuts = defaultdict(list)
    for r in removed:
        cuts[r.doc_id].append((r.start, r.end))
    return [
        sum(any(s <= a and b <= e for s, e in near) for a, b in spans) / len(spans)
        for doc, spans in _runs(documents)
        for near in [[c for c in cuts[doc] if c[1] > spans[0][0] and c[0] < spans[-1][1]]]
    ]


def test_repeated_windows_are_covered(spark):
    documents = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    shares = _shares(documents, QUERIES["op8_line_dedup"](spark, FOLDER).collect())
    assert len(shares) > 100
    assert sum(share < 0.5 for share in shares) <= 0.03 * len(shares)
    assert sum(share == 0 for share in shares) <= 0.01 * len(shares)


def test_passages_inside_longer_sentences(spark):
    rng = random.Random(5)
    text = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    rows = []
    for k in range(0, 200, 2):
        passage = text(rng.randrange(50, 120))
        for doc in (k, k + 1):
            given = passage if doc == k else [w.upper() for w in passage]
            rows.append((doc, " ".join([*text(rng.randrange(1, 40)), *given, *text(rng.randrange(1, 40))])))
    removed = line_dedup.removals(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    shares = _shares(rows, removed)
    assert len(shares) == 100 and all(r.doc_id % 2 for r in removed)
    assert sum(shares) >= 0.75 * len(shares) and sum(share < 0.5 for share in shares) <= 5


def test_words_in_short_turns(spark):
    rows = [(1, "on " * 81), (2, "x y " + "on " * 80), (3, "a b c " * 40), (4, "q " + "b c a " * 40)]
    removed = line_dedup.removals(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(share >= 0.5 for share in _shares(rows, removed))


def test_short_sentences_stay_whole():
    sentence = "one two three four five six seven eight nine ten eleven."
    assert [u[1:] for u in line_dedup.units(f" {sentence} {sentence}")] == [(1, 57, 11), (58, 114, 11)]
