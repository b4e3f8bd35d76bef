"""Every stage of the pipeline against a plain version of its decision."""

import corpus_pipeline
from tallyloom.llm import quality
from tallyloom.llm.queries import QUERIES
from tests.llm.test_ngram_join import brute

FOLDER = "/root/testdata/sf0.01"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stages_and_run(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = f"{tmp_path}/{k}"
        stage(spark, docs, FOLDER).write.parquet(out)
        before, docs = docs, spark.read.parquet(out)
        seen.append((name, before, docs))
        if k < 4:
            assert docs.columns == columns
    assert [s[0] for s in seen] == ["quality", "exact_dedup", "ngram_join", "decontamination", "mixing"]

    _, before, after = seen[0]
    scored = {r.doc_id: r.predicted for r in QUERIES["op5_quality"](spark, FOLDER).collect()}
    assert {r.doc_id for r in after.collect()} == {d for d, p in scored.items() if p}

    _, before, after = seen[1]
    best = {}
    for r in before.collect():
        key = "".join(r.text.split()) if r.text else ""
        key = "".join(c for c in (r.text or "") if c not in " \t\n\x0b\x0c\r")
        rank = (-len(r.text or ""), r.doc_id)
        best[key] = min(best.get(key, (rank, r)), (rank, r), key=lambda x: x[0])
    assert _rows(after) == sorted(tuple(r) for _, r in best.values())

    _, before, after = seen[2]
    names = brute([(r.doc_id, r.text) for r in before.collect()])
    assert {r.doc_id for r in after.collect()} == {i for i, (_, c) in names.items() if i == c}

    _, before, after = seen[3]
    from tallyloom.llm import decontamination

    leaked = {r.doc_id for r in decontamination.leaks(before, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - leaked

    _, before, after = seen[4]
    assert {r.doc_id for r in after.collect()} <= {r.doc_id for r in before.collect()}
    assert _rows(corpus_pipeline.run(spark, FOLDER)) == _rows(after)


def test_accepts_whole_rows(spark):
    df = spark.createDataFrame([(1, "a", None, 2.0), (1, None, "x", None)], "doc_id long, text string, lang string, score double")
    model = quality.Model(b"", b"", None, 0.5)
    assert quality.accepted(df, model).count() == 2 and quality.accepted(df, model, 0.6).count() == 0
    assert quality.accepted(df, model).columns == df.columns
