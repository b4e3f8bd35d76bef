"""Language of a text by compression: the dictionary that fits best wins.

Each language has a dictionary of raw text from a bounded sample of labelled
rows (``BOUND``: whole texts of at most 4,000 characters). A text is compressed under each; the smallest total
names the language. Texts and dictionaries are reduced to lower-case letters
with single spaces first, so that capitals, digits and punctuation do not hide
the words. The margin to the second smallest total gives the score, and a
margin below ``min_margin`` marks the answer as rejected.

Defined results: a text that is null or has no letter is ``und`` with score 0;
ties (very short texts) go to the language with more labelled rows, then to the
one that sorts first; with one language learned every text with a letter has
it; with none every text is ``und``; repeated rows are answered each; an empty
table gives no rows. A row without an id is answered like any other.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.compression import SampleBound, Sizer, bounded_sample, dictionary_bytes, texts_of

UNKNOWN = "und"
BOUND = SampleBound(rows=60)
LEVEL = 6
NO_LETTER = re.compile(r"[\W\d_]+")
# Share of the best size by which the second must be larger.
MIN_MARGIN = 0.02


def letters(text: str) -> str:
    """Lower-case letters of a text, its words between single spaces."""
    return f" {NO_LETTER.sub(' ', text.lower())} "


def learn(rows: DataFrame, bound: SampleBound = BOUND) -> dict[str, bytes]:
    """Dictionary of each language from rows (doc_id, text, lang), the frequent ones first.

    What comes to the driver is bounded by the number of languages.
    """
    usable = F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    labelled = rows.where(usable).select("lang", "text", F.xxhash64("doc_id").alias("order"))
    # A language that has only longer texts is learned from those.
    short = F.length("text") <= bound.characters
    lengths = labelled.groupBy("lang").agg(F.count(F.when(short, 1)).alias("short"), F.count(F.lit(1)).alias("count"))
    sample: dict[str, list] = {}
    counted = {row.lang: (row["count"], row.short) for row in lengths.collect()}
    often = {lang: n for lang, (n, _) in counted.items()}
    counts = rows.sparkSession.createDataFrame(sorted((lang, few or n) for lang, (n, few) in counted.items()), "lang string, count long")
    only_long = [lang for lang, (_, few) in counted.items() if not few]
    labelled = labelled.where(short | F.col("lang").isin(only_long))
    for row in bounded_sample(labelled, "lang", F.col("order"), bound, counts).select("lang", "place", "text").collect():
        sample.setdefault(row.lang, []).append((row.place, row.text))
    order = sorted(sample, key=lambda lang: (-often[lang], lang))
    return {lang: dictionary_bytes([letters(t) for _, t in sorted(sample[lang])]) for lang in order}


def predict(documents: DataFrame, model: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of whole texts; reads nothing else of a row."""
    languages, context = list(model), documents.sparkSession.sparkContext
    shared = context.broadcast([model[lang] for lang in languages])

    def answer(sizer, text):
        if text is None or not languages or not any(c.isalpha() for c in text):
            return UNKNOWN, 0.0, True
        sizes, _ = sizer.sizes(letters(text))
        best, *rest = sorted((size, k) for k, size in enumerate(sizes))
        margin = (rest[0][0] - best[0]) / best[0] if rest else 1.0
        return languages[best[1]], margin / (margin + MIN_MARGIN) if margin else 0.0, margin < min_margin

    def run(batches):
        sizer = Sizer(shared.value, LEVEL)
        for batch in batches:
            found = [answer(sizer, text) for text in texts_of(batch["text"])]
            lang, score, rejected = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def held_out(documents: DataFrame, share: int = 5, rest: int = 0):
    """True where the checksum of the id, as text, leaves ``rest``; a row without an id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(share)) == rest, F.lit(False))
