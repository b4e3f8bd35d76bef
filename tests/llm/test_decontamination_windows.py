"""The windows behind the singular vectors hold every word."""

import numpy as np

from tallyloom.llm import decontamination


def test_windows_hold_all_words():
    for n in (1, 2, 31, 32, 33, 40, 48, 49, 64, 65, 79, 80, 200):
        codes = np.arange(n)
        windows = decontamination._windows(codes, 32)
        assert all(len(w) for w in windows) and np.array_equal(np.concatenate(windows), codes)


def test_segment_sums_equal_reduceat():
    rng = np.random.default_rng(5)
    table = rng.integers(-99, 99, (50, 7)).astype(np.float32)
    for counts in ([], [1], rng.integers(1, 9, 20_000), [1, decontamination.RUN, decontamination.RUN + 1, 40 * decontamination.RUN * decontamination.RUN + 3, 2]):
        counts = np.array(counts, dtype=np.int64)
        rows = rng.integers(0, 50, counts.sum())
        begin = np.cumsum(counts) - counts
        want = np.add.reduceat(table[rows].astype(np.float64), begin, axis=0) if len(counts) else np.zeros((0, 7))
        assert np.array_equal(decontamination.segment_sums(table, rows, begin, counts), want)


def test_candidates_are_dropped_by_document_first(monkeypatch):
    """An item whose words a document lacks is not searched for window by window; a leak still is found."""
    vocabulary = np.arange(40, dtype=np.uint64)
    items = decontamination.Items([1, 2], vocabulary, [np.arange(20), np.arange(20, 40)], [np.arange(15, 20), np.arange(35, 40)])
    documents = [np.tile(np.arange(10), 30), np.append(np.full(64, 40), np.arange(20, 40))]
    searcher = decontamination.Searcher(items, np.ones((40, 2), dtype=np.float32), np.ones(41, dtype=np.float32), np.append(np.ones(40, dtype=bool), False), -1.0)
    asked, verified = [], decontamination.Searcher.verified
    monkeypatch.setattr(decontamination.Searcher, "verified", lambda s, document, start, w, k, *rest: asked.append((len(document), k)) or verified(s, document, start, w, k, *rest))
    found = searcher.search(documents, searcher.prepared())
    assert set(asked) == {(300, 0), (84, 1)}
    assert [(d, k, common, ratio) for d, k, _, _, common, ratio, *_ in found] == [(1, 1, 20, 1.0)]
