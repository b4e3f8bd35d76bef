"""Training-data pipeline over ``documents``: five stages, each on all that the one before kept.

1. quality classifier: documents it rejects go;
2. exact duplicates: the longest of equal texts stays;
3. n-gram Jaccard join: the smallest id of each group of near copies stays;
4. benchmark decontamination: documents that hold a benchmark item go;
5. mixing: one row per reading of a document, in training order.

A stage's result is written and read back, so a lost executor costs no earlier
stage. Ids to be dropped are broadcast only up to a checked size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import decontamination, exact_dedup, mixing, ngram_join, quality
from tallyloom.llm.compression import sampled_labels, with_texts
from tallyloom.llm.language_id import held_out
from tallyloom.operators.sizing import broadcast_if_small
from tallyloom.session import scratch_table
from tallyloom.sources.tables import table


def _without(docs: DataFrame, dropped: DataFrame, key: str = "doc_id") -> DataFrame:
    return docs.join(broadcast_if_small(scratch_table(dropped.select(key).distinct(), "dropped")), key, "left_anti")


def _ids_tell(docs: DataFrame) -> bool:
    """Whether every row has an id and no other row has the same."""
    return not docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").head(1)


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """Rows with a key of id and text, for tables whose ids do not tell rows apart, and the key's name."""
    [key] = exact_dedup.apart(docs.columns, "_key")
    return docs.withColumn(key, F.xxhash64("doc_id", "text")), key


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model learns from the labelled rows of the whole table, but for the held-out third."""
    labels = table(spark, sf_dir, "labels")
    labels = labels.where(~held_out(labels, 3, 1))
    sample = with_texts(table(spark, sf_dir, "documents"), sampled_labels(labels, "quality", quality.sample_rows()))
    share = labels.where(F.col("quality").isin(0, 1)).agg(F.avg("quality")).first()[0]
    return quality.accepted(docs, quality.learn(sample, share=share))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    if _ids_tell(docs):
        return _without(docs, ngram_join.near_duplicates(docs).where("component_id <> doc_id")).select(*docs.columns)
    keyed, key = _keyed(docs)
    found = ngram_join.near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"))
    members = found.select(F.col("doc_id").alias(key), "component_id").distinct().join(keyed.select(key, "doc_id").distinct(), key)
    members = scratch_table(members, "members")
    # Rows without an id give way to those with one.
    first = members.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", key))[key].alias("first"))
    return _without(keyed, members.join(first, "component_id").where(F.col(key) != F.col("first")), key).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark")
    if _ids_tell(docs):
        return _without(docs, decontamination.leaks(docs, benchmark)).select(*docs.columns)
    keyed, key = _keyed(docs)
    found = decontamination.leaks(keyed.select(F.col(key).alias("doc_id"), "text"), benchmark)
    return _without(keyed, found.select(F.col("doc_id").alias(key)), key).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.training_order(mixing.mix(docs))


STAGES = [
    ("quality", quality_filter),
    ("exact_dedup", exact_duplicates),
    ("ngram_join", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
]

# Compression and singular vectors have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
