"""Null ids and ids with several texts in exact duplicates and the pipeline."""

import corpus_pipeline
from tallyloom.llm import exact_dedup, ngram_join

FOLDER = "/root/testdata/sf0.001"
PROSE = " ".join(f"word{k}" for k in range(60))
OTHER = " ".join(f"other{k}" for k in range(20))
SHORT = " ".join(f"short{k}" for k in range(20))


def _table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def _half(spark, half):
    rows = spark.range(50).selectExpr("id", f"pmod(xxhash64(id), 2) = {half} AS there").where("there")
    return [r.id for r in rows.collect()]


def test_null_id_across_the_halves(spark):
    stored = _half(spark, 1)[0]
    df = _table(spark, [(None, "a  b"), (stored, "a b"), (stored + 100, "c")])
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.in_two_batches(df).collect()}
    assert got == {(None, stored, 2, False), (stored, stored, 2, True), (stored + 100, stored + 100, 1, True)}
    assert sorted(tuple(r) for r in exact_dedup.kept_documents(df).collect()) == [(stored, "a b"), (stored + 100, "c")]


def test_id_with_two_texts(spark):
    for one in (_half(spark, 0)[1], _half(spark, 1)[1]):
        df = _table(spark, [(0, "a b"), (one, "ab"), (one, "unique"), (None, "ab"), (None, "alone"), (None, "x y"), (None, "xy")])
        got = sorted((tuple(r) for r in exact_dedup.kept_documents(df).collect()), key=str)
        assert got == sorted([(0, "a b"), (one, "unique"), (None, "alone"), (None, "x y")], key=str)


def test_stages_drop_rows_by_id_and_text(spark):
    leak = spark.read.parquet(f"{FOLDER}/benchmark.parquet").orderBy("item_id").first().text
    df = _table(spark, [(1, PROSE), (2, f"{PROSE} more"), (2, OTHER), (None, f"{PROSE} end"), (3, SHORT), (3, leak)])
    near = {tuple(r) for r in corpus_pipeline.near_duplicates(spark, df, FOLDER).collect()}
    assert near == {(1, PROSE), (2, OTHER), (3, SHORT), (3, leak)}
    clean = {tuple(r) for r in corpus_pipeline.decontaminate(spark, df, FOLDER).collect()}
    assert {tuple(r) for r in df.collect()} - clean == {(3, leak)}


def test_smallest_id_and_clashing_columns(spark):
    low = -(2**63)
    df = spark.createDataFrame([(low, "a b", 1, 2, 3, 4), (5, "ab", 1, 2, 3, 4), (5, "ab", 1, 2, 3, 4), (6, "c", 1, 2, 3, 4)], "doc_id long, text string, _id int, _sha int, _key int, _DIGEST int")
    got = {(r.doc_id, r.keep_id, r.kept) for r in exact_dedup.in_two_batches(df).collect()}
    assert got == {(low, low, True), (5, low, False), (6, 6, True)}
    kept = exact_dedup.kept_documents(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [low, 6]
    rows = spark.createDataFrame([(1, PROSE, 7), (1, f"{PROSE} more", 7), (2, OTHER, 7)], "doc_id long, text string, _key int")
    near = corpus_pipeline.near_duplicates(spark, rows, FOLDER)
    assert near.columns == rows.columns and {tuple(r) for r in near.collect()} == {(2, OTHER, 7), (1, PROSE, 7)} or {tuple(r) for r in near.collect()} == {(2, OTHER, 7), (1, f"{PROSE} more", 7)}


def test_sets_of_rows_that_share_an_id(spark):
    df = _table(spark, [(1, PROSE), (1, SHORT), (None, OTHER), (None, None), (2, f"{PROSE} more"), (3, "one two")])
    got = sorted((tuple(r) for r in ngram_join.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 56, 1), (1, 16, 1), (None, 16, None), (None, 0, None), (2, 57, 1), (3, 1, 3)], key=str)
