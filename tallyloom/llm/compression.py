"""Classification by compression: raw-content dictionaries and sizes under them.

A text is cut into blocks and every block is compressed on its own under each
dictionary. Without blocks a long text would soon be its own dictionary and the
labelled one would no longer matter; with them every part of a text counts the
same, and memory is bounded by a block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BYTES = 4096
LEVEL = 3


@dataclass(frozen=True)
class SampleBound:
    """The bounded sample that dictionaries are made of.

    Of each label at most ``rows`` rows, each of them whole; only texts of at
    most ``characters`` characters are taken into a dictionary, so that one
    text cannot fill it.
    """

    rows: int
    characters: int = 4000


# Rows of a label that pass the first, hashed cut of a sample, for each that is kept.
THINNED = 4


def bounded_sample(rows: DataFrame, label: str, order: Column, bound: SampleBound, counts: DataFrame) -> DataFrame:
    """At most ``bound.rows`` rows of each label, the first by ``order``, a hash of the id.

    ``counts`` (label, count) has a row per label. A label with more rows is
    first thinned by the hash to about ``THINNED`` times the bound in all tasks
    together, so what meets for the final cut does not grow with the table.
    """
    share = F.lit(float(THINNED * bound.rows)) / F.col("count")
    thinned = rows.join(F.broadcast(counts), label).where(F.pmod(F.xxhash64(order), F.lit(1 << 30)) < share * (1 << 30))
    place = F.row_number().over(Window.partitionBy(label).orderBy(order))
    return thinned.withColumn("place", place).where(F.col("place") <= bound.rows).drop("count")


def sampled_labels(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, label) of at most ``rows`` rows of each label 0 and 1.

    Ids are sampled before any text is read, so that only the sampled texts
    are moved.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", label)
    counts = known.groupBy(label).count()
    return bounded_sample(known, label, F.xxhash64("doc_id"), SampleBound(rows=rows), counts).drop("place")


def with_texts(documents: DataFrame, sample: DataFrame) -> DataFrame:
    """The sampled rows with their texts; the sample is bounded, so it is broadcast."""
    return documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")


def dictionary_bytes(texts: Sequence[str]) -> bytes:
    """Raw content of one dictionary, of whole texts; what comes last is found cheapest."""
    return "\n".join(texts).encode("utf-8", "surrogatepass")


class Sizer:
    """Compressed sizes of a text under several dictionaries; None is no dictionary."""

    def __init__(self, dictionaries: Sequence[bytes | None], level: int = LEVEL):
        self.compressors = []
        for raw in dictionaries:
            options = {"level": level, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
            if raw:
                loaded = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                loaded.precompute_compress(level=level)
                options["dict_data"] = loaded
            self.compressors.append(zstandard.ZstdCompressor(**options))

    def sizes(self, text: str) -> tuple[np.ndarray, int]:
        """(bytes under each dictionary, bytes of the text)."""
        data = memoryview(text.encode("utf-8", "surrogatepass"))
        total = np.zeros(len(self.compressors))
        for start in range(0, len(data), BLOCK_BYTES):
            block = data[start : start + BLOCK_BYTES]
            for k, compressor in enumerate(self.compressors):
                total[k] += len(compressor.compress(block))
        return total, len(data)


def texts_of(batch) -> Iterator[str | None]:
    """Texts of an Arrow column one by one; none is held longer than needed."""
    return (value.as_py() for value in batch)


def fit_logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 0.1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(means, scales, weights) of a ridge logistic model, by Newton steps.

    With one label only, the weights give that label with little doubt.
    """
    means, scales = features.mean(axis=0), features.std(axis=0) + 1e-9
    design = np.column_stack([np.ones(len(features)), (features - means) / scales])
    penalty = ridge * np.eye(design.shape[1])
    weights = np.zeros(design.shape[1])
    for _ in range(40):
        chance = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (chance - labels) + penalty @ weights
        curve = (design * (chance * (1 - chance))[:, None]).T @ design + penalty
        weights = np.clip(weights - np.linalg.solve(curve, slope), -30, 30)
    return means, scales, weights


def logistic(features: np.ndarray, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    means, scales, weights = model
    drive = np.column_stack([np.ones(len(features)), (features - means) / scales]) @ weights
    return 1 / (1 + np.exp(-np.clip(drive, -30, 30)))
