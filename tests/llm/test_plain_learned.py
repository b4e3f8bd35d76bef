"""Language, quality and toxicity against plain versions, on all rows whose id is divisible by 20."""

import math
import re

import pytest
import zstandard
from pyspark.sql import functions as F

from tallyloom.llm import language_id, quality, toxicity
from tallyloom.llm.compression import SampleBound, bounded_sample, sampled_labels, with_texts
from tallyloom.llm.language_id import held_out

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    return documents, labels.where(~held_out(labels, 3, 1))


@pytest.fixture(scope="module")
def asked(tables):
    return {r.doc_id: r.text for r in tables[0].where("doc_id % 20 = 0").select("doc_id", "text").collect()}


def _plain_size(text, raw, level):
    """Compressed bytes of a text in blocks of 4,096 bytes, each on its own."""
    data = text.encode("utf-8")
    dictionary = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if raw else None
    if dictionary:
        dictionary.precompute_compress(level=level)
    total = 0
    for start in range(0, len(data), 4096):
        plain = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False)
        total += len(plain.compress(data[start : start + 4096]))
    return total


def test_language_against_plain(tables, asked):
    documents = tables[0]
    model = language_id.learn(documents.where(~held_out(documents)))
    got = {r.doc_id: r for r in language_id.predict(documents, model).where("doc_id % 20 = 0").collect()}
    assert len(got) == len(asked) > 40
    for doc_id, text in asked.items():
        if not text or not re.search(r"[^\W\d_]", text):
            assert got[doc_id].lang_pred == "und" and got[doc_id].score == 0
            continue
        words = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
        words = re.sub(" {2,}", " ", words[1:-1])
        words = f" {words} "
        sizes = sorted((_plain_size(words, raw, 6), k, lang) for k, (lang, raw) in enumerate(model.items()))
        margin = (sizes[1][0] - sizes[0][0]) / sizes[0][0]
        assert got[doc_id].lang_pred == sizes[0][2]
        assert got[doc_id].score == pytest.approx(margin / (margin + 0.02) if margin else 0.0)


def test_quality_against_plain(tables, asked):
    documents, labels = tables
    sample = with_texts(documents, sampled_labels(labels, "quality", quality.sample_rows()))
    model = quality.learn(sample, share=0.4)
    means, scales, weights = model.logistic
    got = {r.doc_id: r for r in quality.score(documents, model).where("doc_id % 20 = 0").collect()}
    for doc_id, text in asked.items():
        want = model.prior
        if text:
            good, bad, plain = (_plain_size(text, raw, 3) for raw in (model.good, model.bad, None))
            n = len(text.encode())
            x = [(bad - good) / plain, plain / (n + 1), good / (n + 1), math.log1p(n) / 10]
            drive = weights[0] + sum(w * (v - m) / s for w, v, m, s in zip(weights[1:], x, means, scales))
            want = 1 / (1 + math.exp(-max(-30, min(30, drive))))
        assert got[doc_id].score == pytest.approx(want, abs=1e-9) and got[doc_id].predicted == int(got[doc_id].score >= 0.5)


def test_every_sampled_row_is_used_whole(spark, tables):
    """Each row of the sample is in a dictionary or in the calibration, and nowhere cut."""
    documents, labels = tables
    bound = SampleBound(rows=20, characters=3000)
    sample = with_texts(documents, sampled_labels(labels, "quality", 60)).where(F.length("text") > 0)
    model, seen = quality.learn(sample, bound=bound), []
    keep = quality.calibration
    try:
        quality.calibration = lambda rows, parts: (seen.extend(rows.select("label", "text").collect()), keep(rows, parts))[1]
        quality.learn(sample, bound=bound)
    finally:
        quality.calibration = keep
    held = {1: model.good.decode(), 0: model.bad.decode()}
    used = {(r.label, r.text) for r in seen}
    for r in sample.select("quality", "text").collect():
        assert (r.quality, r.text) in used or r.text in held[r.quality]
    rows = documents.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (F.length("text") <= 3000))
    learned = language_id.learn(documents, bound)
    taken = bounded_sample(rows.select("lang", "text", F.xxhash64("doc_id").alias("order")), "lang", F.col("order"), bound, rows.groupBy("lang").count())
    for r in taken.collect():
        assert language_id.letters(r.text) in learned[r.lang].decode()


def _plain_clause(clause, words, stems):
    """Five readers side by side, none of them composed."""
    threat = target = negation = 0
    report, total = 0, 0.0
    for token in toxicity.TOKEN.findall(clause):
        strength, kind = 0.0, "other"
        if token in "\"“”«»":
            kind = "quote"
        else:
            strength = words.get(token, 0.0) or next((stems[token[:n]] for n in sorted({len(s) for s in stems}) if token[:n] in stems and n <= len(token)), 0.0)
            for name, listed in (("threat", toxicity.THREATS), ("target", toxicity.TARGETS), ("negation", toxicity.NEGATIONS), ("report", toxicity.REPORTS)):
                kind = name if token in listed else kind
            kind = "insult" if strength else kind
        emitted = (strength if kind == "insult" else 0.0, 1.5 if threat and kind in ("target", "insult") else 0.0)
        scale = (1.5 if target else 1.0) * (0.3 if negation else 1.0) * (0.5 if report else 1.0)
        # What an insult weighs scales the whole of what is emitted at it.
        total += (scale * ((1.0 if kind == "insult" else 0.0) + emitted[1])) * (strength if kind == "insult" else 1.0)
        threat = 6 if kind == "threat" else (0 if emitted[1] else max(0, threat - 1))
        target = 6 if kind == "target" else max(0, target - 1)
        negation = 3 if kind == "negation" else max(0, negation - 1)
        report = {0: 2, 1: 2, 2: 0}[report] if kind == "quote" else (1 if kind == "report" and report == 0 else report)
    return total


def test_toxicity_against_plain(tables, asked):
    documents, labels = tables
    model = toxicity.learn(with_texts(documents, sampled_labels(labels, "toxic", toxicity.LABELLED.rows)))
    words = {w: 1.0 for w in toxicity.INSULTS} | model.words
    found = 0
    toxic = {r.doc_id: r.text for r in documents.join(labels.where("toxic = 1"), "doc_id").select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in toxicity.score(documents, model).collect()}
    for doc_id, text in {**asked, **toxic}.items():
        # A clause counts only where it holds an insult or a threat as a word of its own.
        want = 0.0
        for clause in re.split(r"[.!?;\n]", (text or "").lower()):
            tokens = toxicity.TOKEN.findall(clause)
            if any(t in words or t in toxicity.THREATS or any(t.startswith(s) for s in model.stems) for t in tokens):
                want += _plain_clause(clause, words, model.stems)
        assert got[doc_id].weight == pytest.approx(want), doc_id
        found += want > 0
    assert found > 10
