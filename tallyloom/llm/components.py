"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import scratch_table


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b); the smallest node names it.

    Each round gives every node the smallest of its neighbours that is smaller
    than itself, follows these pointers to their ends, and contracts the links
    to what is left between different ends. The number of rounds grows with the
    logarithm of the number of nodes. Smallest neighbours are found by sums made
    before the shuffle, so a node with very many links is no single group.
    """
    both = links.where("a <> b").select("a", "b")
    edges = scratch_table(both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    labels = scratch_table(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node")), "labels")
    while not edges.isEmpty():
        parents = scratch_table(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent")), "parents")
        while True:
            further = parents.alias("p").join(parents.alias("q"), F.col("p.parent") == F.col("q.node"), "left")
            jumped = scratch_table(
                further.select(
                    F.col("p.node").alias("node"),
                    F.coalesce("q.parent", "p.parent").alias("parent"),
                    F.col("q.node").isNotNull().alias("moved"),
                ),
                "parents",
            )
            parents = jumped.drop("moved")
            if jumped.where("moved").isEmpty():
                break
        labels = scratch_table(
            labels.alias("l").join(parents.alias("p"), F.col("l.component") == F.col("p.node"), "left").select(
                F.col("l.node").alias("node"), F.coalesce("p.parent", "l.component").alias("component")
            ),
            "labels",
        )
        ends = edges
        for column in ("a", "b"):
            ends = ends.alias("e").join(parents.alias("p"), F.col(f"e.{column}") == F.col("p.node"), "left").select(
                *(F.col(f"e.{c}").alias(c) for c in ("a", "b") if c != column), F.coalesce("p.parent", f"e.{column}").alias(column)
            )
        ends = ends.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        edges = scratch_table(ends, "edges")
    return labels
