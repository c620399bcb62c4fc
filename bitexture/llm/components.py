"""Connected components by hooking every label to its smallest neighbour, with joins and partial aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitexture.llm.common import staged


def _between(edges: DataFrame) -> DataFrame:
    """Distinct edges (u, v) with u < v."""
    ordered = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    return ordered.where("u < v").distinct()


def _through(df: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    """Replace a label by what it hooks to."""
    renamed = hooks.select(F.col("u").alias(column), F.col("to").alias("_to"))
    joined = df.join(renamed, column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to")
    return joined.select(*df.columns)


def merge_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels ``(node, label)`` after the links ``(a, b)`` between nodes are added.

    Nodes that no link has reached may be missing from ``labels``: their label is the node itself. In each round every
    label goes to its smallest neighbour and one step beyond, and the edges shrink to those between different labels.
    A hub is an aggregate on one side and a join key that can be split on the other.
    """
    nodes = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    labels = labels.join(nodes, "node", "full").select("node", F.coalesce("label", "node").alias("label"))
    labels = staged(labels, "labels")
    of = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias("_" + end))
    edges = links.join(of("a"), "a").join(of("b"), "b").select(F.col("_a").alias("u"), F.col("_b").alias("v"))
    edges = staged(_between(edges), "edges")
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooks = both.groupBy("u").agg(F.min("v").alias("to")).where(F.col("to") < F.col("u"))
        hooks = staged(hooks, "hooks")
        hooks = staged(_through(hooks, "to", hooks), "hooks")
        labels = staged(_through(labels, "label", hooks), "labels")
        edges = staged(_between(_through(_through(edges, "u", hooks), "v", hooks)), "edges")
    return labels
