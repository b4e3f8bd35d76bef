"""Quality by compression: dictionaries of good and of bad text.

Two dictionaries are made of a bounded sample of labelled rows. The difference
of the compressed sizes, divided by the size without a dictionary, is the main
feature; how far a text compresses at all (repeats) and its length go with it.
A logistic model, fitted on the other rows of the bounded sample, turns them into
a calibrated score. Every sampled row is in a dictionary or in the calibration,
whole; only the features of the latter come to the driver.

Defined results: a null text counts as empty; empty texts get the score of
zero features, which is the share of good rows in the sample; without labelled
rows every score is 0.5; repeated rows are scored each; an empty table gives no
rows. Labels other than 0 and 1, and null ones, are not learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.compression import (
    SampleBound,
    Sizer,
    bounded_sample,
    dictionary_bytes,
    fit_logistic,
    logistic,
    texts_of,
)
from tallyloom.session import scratch_table

DICTIONARY = SampleBound(rows=160)
# Rows of each label that calibrate the score; none of them is in a dictionary.
CALIBRATION_ROWS = 1500


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    logistic: tuple | None
    prior: float


def features(sizer: Sizer, text: str | None) -> list[float] | None:
    """None for an empty text."""
    if not text:
        return None
    (good, bad, plain), size = sizer.sizes(text)
    return [(bad - good) / plain, plain / (size + 1), good / (size + 1), float(np.log1p(size)) / 10]


def sample_rows(bound: SampleBound = DICTIONARY) -> int:
    """Rows of each label that ``learn`` uses."""
    return bound.rows + CALIBRATION_ROWS


def learn(rows: DataFrame, label: str = "quality", bound: SampleBound = DICTIONARY, share: float | None = None) -> Model:
    """Fit on rows (doc_id, text, label); the sample is bounded on its way to the driver.

    ``share`` is the share of label 1 among all labelled rows, where ``rows``
    were sampled by label already.
    """
    labelled = rows.where(F.col(label).isin(0, 1) & (F.length("text") > 0)).select(
        F.col(label).cast("int").alias("label"), "text", F.xxhash64("doc_id").alias("order")
    )
    wanted = SampleBound(rows=sample_rows(bound))
    sample = scratch_table(bounded_sample(labelled, "label", F.col("order"), wanted, labelled.groupBy("label").count()), "sample")
    # The dictionary takes every second row until it is full, but for very long ones.
    in_dictionary = (F.col("place") % 2 == 0) & (F.col("place") <= 2 * bound.rows) & (F.length("text") <= bound.characters)
    held = sorted(tuple(r) for r in sample.where(in_dictionary).select("label", "place", "text").collect())
    if sample.isEmpty():
        return Model(b"", b"", None, 0.5)
    parts = [dictionary_bytes([t for y, _, t in held if y == label_]) for label_ in (1, 0)]
    # The sample is bounded for each label, so the share of labels comes from all rows.
    if share is None:
        share = labelled.agg(F.avg("label")).first()[0]
    x, y = calibration(sample.where(~in_dictionary), parts)
    if len(set(y)) < 2:
        return Model(*parts, None, share)
    means, scales, weights = fit_logistic(x, y)
    sampled = y.mean()
    weights = weights.copy()
    weights[0] += np.log(share / (1 - share)) - np.log(sampled / (1 - sampled))
    return Model(*parts, (means, scales, weights), share)


def calibration(rows: DataFrame, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of rows (label, text) under the dictionaries, in a fixed order."""

    def run(batches):
        sizer = Sizer([*parts, None])
        for batch in batches:
            found = [features(sizer, text) for text in texts_of(batch["text"])]
            yield pa.RecordBatch.from_arrays(
                [batch["label"], batch["place"], pa.array(found, pa.list_(pa.float64()))], names=["label", "place", "x"]
            )

    found = rows.select("label", "place", "text").mapInArrow(run, "label int, place int, x array<double>").collect()
    found = sorted((r.label, r.place, r.x) for r in found)
    return np.array([x for _, _, x in found]), np.array([y for y, _, _ in found])


class Scorer:
    """Scores of the texts of an Arrow column."""

    def __init__(self, model: Model):
        self.model, self.sizer = model, Sizer([model.good, model.bad, None])

    def scores(self, texts) -> np.ndarray:
        found = [features(self.sizer, text) for text in texts_of(texts)]
        scores = np.full(len(found), self.model.prior)
        some = [k for k, f in enumerate(found) if f is not None]
        if some and self.model.logistic:
            scores[some] = logistic(np.array([found[k] for k in some]), self.model.logistic)
        return scores


def score(documents: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """(doc_id, score, predicted) of whole texts; reads nothing else of a row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            scores = scorer.scores(batch["text"])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores)], names=["doc_id", "score"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(documents: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows, whole, whose score is not below the threshold; nothing is shuffled."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            yield batch.filter(pa.array(scorer.scores(batch["text"]) >= threshold))

    return documents.mapInArrow(run, documents.schema)
