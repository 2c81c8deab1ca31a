"""Connected components of a distributed edge list, by hooking, shortcutting and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop, join_skewed, stage


def _followed(left: DataFrame, labels: DataFrame, total: int) -> DataFrame:
    """``left`` (node, label, ...) with ``further``: the label of its label in ``labels`` (node, label), or null."""
    held = left.groupBy(F.col("label").cast("string").alias("key")).agg(F.count("*").alias("rows"))
    further = labels.select(F.col("node").cast("string").alias("key"), F.col("label").alias("further")).join(held, "key")
    return join_skewed(left.withColumn("key", F.col("label").cast("string")), further, "key", "rows", total, F.col("node"))


def _contracted(edges: DataFrame, labels: DataFrame, total: int) -> DataFrame:
    """Distinct edges (a, b) between the labels of ``labels`` (node, label, degree); those within one label go."""
    names = labels.select(F.col("node").cast("string").alias("key"), "label", "degree")
    for _ in range(2):  # the other end each time
        edges = join_skewed(edges.withColumn("key", F.col("a").cast("string")), names, "key", "degree", total, F.col("b"))
        edges = edges.select(F.col("b").alias("a"), F.col("label").alias("b")).distinct()
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, label) for every node of ``edges`` (a long, b long); label is its component's smallest node.

    Each round hooks every node to its smallest neighbour, if that is smaller, follows the hooks to their ends by
    doubling, and contracts the graph to those ends, so an edge is read again only while its ends are apart. Minima are
    combined before they are shuffled; hot labels and nodes are joined apart. Each step is a written table.
    """
    spark, n = edges.sparkSession, 0
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = stage(edges, f"{folder}/edges-0")
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    while left := edges.count():
        both = edges.union(edges.select("b", "a")).toDF("node", "near")
        near = both.groupBy("node").agg(F.min("near").alias("near"), F.count("*").alias("degree"))
        hooks = stage(near.select("node", F.least("node", "near").alias("label"), "degree"), f"{folder}/hooks-{n}-0")
        total, k = hooks.count(), 0
        while True:
            further = F.coalesce("further", "label")
            ends = _followed(hooks, hooks, total).select("node", further.alias("label"), "degree", (further != F.col("label")).alias("moved"))
            ends = stage(ends, f"{folder}/hooks-{n}-{k + 1}")
            moved = ends.where("moved").limit(1).count()
            drop(spark, f"{folder}/hooks-{n}-{k}")
            hooks, k = ends.drop("moved"), k + 1
            if not moved:
                break
        if n:
            new = _followed(labels, hooks, labels.count()).select("node", F.coalesce("further", "label").alias("label"))
        else:
            new = hooks.select("node", "label")
        labels = stage(new, f"{folder}/labels-{n}")
        edges = stage(_contracted(edges, hooks, left), f"{folder}/edges-{n + 1}")
        for part in (f"hooks-{n}-{k}", f"edges-{n}", f"labels-{n - 1}"):
            drop(spark, f"{folder}/{part}")
        n += 1
    return labels
