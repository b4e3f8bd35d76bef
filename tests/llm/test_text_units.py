"""Line dedup and mixing against plain Python on small tables."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import line_dedup, mixing
from tallyloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def _brute(documents, min_words=line_dedup.MIN_WORDS):
    best, every = {}, []
    for doc_id, text in documents:
        for digest, start, end, words in line_dedup.units(text or "", min_words):
            every.append((doc_id, start, end, words, digest))
            best[digest] = min(best.get(digest, (doc_id, start)), (doc_id, start))
    return sorted((d, s, e, w, best[g][0]) for d, s, e, w, g in every if (d, s) != best[g])


def test_removals_match_brute_force(spark):
    documents = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op8_line_dedup"](spark, FOLDER).collect())
    assert got == _brute(documents)


def test_removals_hard_rows(spark):
    line = "one two three four five six seven"
    rows = [
        (3, f"{line}.\nA b.\n{line.upper()}!\né {line}"), (2, f"  One  two three\tfour five six seven.\nOther"), (4, None), (5, ""),
        (6, "Yes. Yes. Yes."), (7, "Yes."), (8, (line + " ") * 20000),
    ]
    df = spark.createDataFrame([(*r, "w", 0) for r in rows], "doc_id long, text string, words string, keep_id int")
    removed = line_dedup.removals(df)
    got = sorted(tuple(r) for r in removed.collect())
    assert got == _brute(rows)
    cut = {r.doc_id: r.text for r in line_dedup.without_removed(df, removed).collect()}
    assert cut[2] == rows[1][1] and cut[4] is None and cut[3].startswith("\nA b.")
    assert line_dedup.removals(df.limit(0)).count() == 0
    spans = {(r.doc_id, r.start) for r in line_dedup.passages(removed).collect()}
    assert (3, 0) in spans


def _water(sources, share=1.5):
    names = sorted(sources, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, target = share * sum(sources.values()), set(names), {}
    while open_:
        per = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if per * weight[s] > 2 * sources[s]}
        if not full:
            return target | {s: per * weight[s] for s in open_}
        target |= {s: 2.0 * sources[s] for s in full}
        left -= sum(2 * sources[s] for s in full)
        open_ -= full
    return target


def _check(rows):
    sources = defaultdict(int)
    for r in rows:
        sources[r.source] += r.size
    aims, taken = _water(sources), defaultdict(int)
    for r in rows:
        assert r.source_size == sources[r.source] and r.target == pytest.approx(aims[r.source])
        assert 0 <= r.taken <= 2 * r.size and sum(d.take for d in r.draws) == r.taken
        assert all(0 <= d.position <= 1 for d in r.draws)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - aims[s]) <= 0.51 for s in sources)


def test_mix_reaches_targets(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    first = mixing.mix(df).collect()
    _check(first)
    again = mixing.mix(df.repartition(13)).collect()
    assert sorted((r.doc_id, r.taken) for r in first) == sorted((r.doc_id, r.taken) for r in again)


def test_mix_hard_rows(spark):
    rows = [(1, "a b c", None), (2, None, "x"), (2, None, "x"), (3, "", "y"), (4, "w " * 50000, "z"), (4, "w " * 50000, "z"), (None, "q r", "")]
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], "doc_id long, text string, source string, size int, position string")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    _check(got)
    assert {r.taken for r in mixing.mix(df.withColumn("text", F.lit(None).cast("string"))).collect()} == {0}
    assert mixing.mix(df.limit(0)).count() == 0


def test_positions_follow_the_schedule(spark):
    df = spark.range(101).select((F.col("id") / 100).alias("u"))
    for knots in mixing.SCHEDULES.values():
        times = [r[0] for r in df.select(mixing.position(F.col("u"), knots)).collect()]
        assert times == sorted(times) and times[0] == 0 and times[-1] == pytest.approx(1)
        area = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))
        for u, t in zip((k / 100 for k in range(101)), times):
            used = 0.0
            for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
                x = min(max(t - t0, 0), t1 - t0)
                used += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
            assert used == pytest.approx(u * area, abs=1e-9)
    order = [r.position for r in mixing.training_order(mixing.mix(spark.read.parquet(f"{FOLDER}/documents.parquet"))).collect()]
    assert order == sorted(order)
