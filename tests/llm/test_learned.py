"""Learned operators: held-out accuracy on the shared tables, and hard rows."""

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import language_id, quality, toxicity
from tallyloom.llm.queries import QUERIES
from tests.oracle import connect  # noqa: F401

FOLDER = "/root/testdata/sf0.1"
HARD = [(1, None, None), (2, "", "en"), (3, "12 34 !!", "en"), (4, "x" * 300000, None), (5, "x" * 300000, None), (5, "É", "fr")]


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame([(*r, 1.0, "z") for r in HARD], "doc_id long, text string, lang string, score double, lang_pred string")


def _held_out_accuracy(spark, name, truth, prediction):
    got = QUERIES[name](spark, FOLDER).where("held_out")
    joined = got.join(truth, "doc_id").where(F.col(prediction[1]).isNotNull())
    return joined.agg(F.avg((F.col(prediction[0]) == F.col(prediction[1])).cast("double"))).first()[0]


def test_language_accuracy(spark):
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    assert _held_out_accuracy(spark, "op2_language_id", truth, ("lang_pred", "lang")) > 0.97


def test_quality_accuracy(spark):
    truth = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    assert _held_out_accuracy(spark, "op5_quality", truth, ("predicted", "quality")) > 0.95


def test_toxicity_accuracy(spark):
    truth = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "toxic")
    assert _held_out_accuracy(spark, "op7_toxicity", truth, ("predicted", "toxic")) > 0.95


def test_language_hard_rows(spark, hard):
    model = language_id.learn(spark.read.parquet(f"{FOLDER}/documents.parquet").limit(500))
    got = [tuple(r)[:2] for r in language_id.predict(hard, model).collect()]
    assert [r for r in got if r[0] in (1, 2, 3)] == [(1, "und"), (2, "und"), (3, "und")]
    assert len(got) == len(HARD) and all(r[1] in model for r in got if r[0] in (4, 5))
    assert {r.lang_pred for r in language_id.predict(hard, {}).collect()} == {"und"}
    assert language_id.predict(hard.limit(0), model).count() == 0
    assert language_id.learn(hard.limit(0)) == {}


def test_quality_hard_rows(spark, hard):
    none = quality.learn(hard.withColumn("quality", F.lit(1)).limit(0))
    assert {r.score for r in quality.score(hard, none).collect()} == {0.5}
    one = quality.learn(hard.withColumn("quality", F.lit(1)))
    assert {r.score for r in quality.score(hard, one).collect()} == {1.0}
    two = quality.learn(hard.withColumn("quality", (F.col("doc_id") % 2).cast("int")))
    assert all(0 <= r.score <= 1 for r in quality.score(hard, two).collect())
    assert quality.score(hard.limit(0), two).count() == 0


def test_toxicity_hard_rows(spark, hard):
    none = toxicity.learn(hard.withColumn("toxic", F.lit(1)).limit(0))
    assert {r.predicted for r in toxicity.score(hard, none).collect()} == {0}
    assert toxicity.score(hard.limit(0), none).count() == 0


def test_grammar_scores_clauses():
    weight = toxicity.Grammar().weight
    assert weight("A plain line.") == weight("") == weight(None) == 0
    assert weight("An idiot.") == 1
    assert weight("You are an idiot.") == 1.5
    assert weight("You. An idiot.") == 1
    assert weight("He is not an idiot.") == pytest.approx(1.5 * 0.3)
    assert weight("Ann said that Bob is an idiot.") == 0.5
    assert weight('"An idiot."') == 0.5
    assert weight("I will kill you.") == 1.5
    assert weight("It did kill the process.") == 0
    assert weight("Idiot! IDIOT! idiotic") == 2
    assert toxicity.Grammar({}, {"lowei": 0.5}).weight("Der loweich, flowei.") == 0.5


def test_lexicon_prefers_stems():
    taken = toxicity.suspects({"loweix": 9, "lowei*": 30, "loweix*": 6, "der": 90}, {"der": 880}, 100, 900)
    assert toxicity.lexicon(taken) == ({}, {"lowei": 1.0})
