"""Work that is divided by a tree: batches of batches under a cap, and clustering one level after the other."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components, greedy_clusters, settle
from .order import numbered
from .trees import ancestors, batches


def hierarchy(edges: DataFrame, cap: int, max_levels: int = 60) -> DataFrame:
    """level, batch, ref, part, leaf: batches of leaves, batches of these, and so on to one that holds all.

    edges: node, parent, name, length. On each level the highest nodes with at most `cap` leaves are the batches, and for the next one the tree ends
    at them. batch numbers a level's batches in order of their nodes; ref is `L<level>B<batch>`; part is a leaf's name (its node where it has none) or
    the ref of a batch of the level before; leaf tells which. A node with more than `cap` children that are leaves can't be cut, an error.
    """
    tree, found, below = settle(edges.select("node", "parent", "name", "length"), merge=True), [], None
    for level in range(1, max_levels + 1):
        leaves = tree.join(tree.select(F.col("parent").alias("node")).distinct(), "node", "left_anti")
        of = settle(batches(tree, cap).select(F.col("leaf").alias("node"), F.col("batch").alias("top")), merge=True)
        order = numbered(of.select("top").distinct(), "top").select("top", F.col("k").alias("batch"))
        named = leaves.select("node", F.coalesce("name", F.col("node").cast("string")).alias("part")) if below is None else below
        rows = of.join(order, "top").join(named, "node").select("top", F.col("batch").cast("int").alias("batch"), "part", F.lit(below is None).alias("leaf"))
        rows = settle(rows.select(F.lit(level).alias("level"), "batch", F.format_string("L%dB%d", F.lit(level), "batch").alias("ref"), "part", "leaf", "top"), merge=True)
        found.append(rows.drop("top"))
        n, parts = rows.agg(F.countDistinct("top"), F.count(F.lit(1))).first()
        if n <= 1:
            return reduce(DataFrame.unionByName, found)
        if n == parts:
            raise ValueError(f"a node has more than {cap} leaves as children")
        below = settle(rows.select(F.col("top").alias("node"), F.col("ref").alias("part")).distinct(), merge=True)
        over = ancestors(tree).join(below.select("node"), "node", "left_semi").select(F.col("ancestor").alias("node")).distinct()
        tree = settle(tree.join(over, "node", "left_semi"), merge=True)
    raise RuntimeError(f"more than {max_levels} levels")


def linked(edges: DataFrame) -> DataFrame:
    """node, cluster by components: a level at a time gives what all at once does."""
    return components(edges.select("a", "b")).toDF("node", "cluster")


def merged_greedily(edges: DataFrame) -> DataFrame:
    """node, cluster by merging along falling scores, at most one member of each unit."""
    return greedy_clusters(edges.select("a", "b", "ga", "gb", "score"))


def by_levels(features: DataFrame, edges: DataFrame, parts: DataFrame, cluster: Callable[[DataFrame], DataFrame] = linked) -> DataFrame:
    """node, cluster: features clustered within batches of genomes, then the clusters within batches of batches, up to the last level.

    features: node, genome; edges: a, b, score; parts: level, ref, part, as hierarchy gives them, parts of level 1 being genomes. A cluster stands for its members on the next level,
    by its smallest one; the batch that it was found in is its pseudo-genome there, and two clusters have the best score between their members.
    cluster: node, cluster of edges (a, b, ga, gb, score); all batches of a level go in one call, as no edge leads from one to another. Clusters found at each
    level are written, and what they stand for is followed back at the end of each.
    """
    of = settle(features.select("node", F.col("node").alias("cluster"), F.col("genome").cast("string").alias("unit")))
    links = settle(edges.where("a <> b").select("a", "b", F.col("score").cast("double").alias("score")))
    last = parts.agg(F.max("level")).first()[0] or 0
    for level in range(1, last + 1):
        into = parts.where(F.col("level") == level).select(F.col("part").alias("unit"), "ref")
        heads = settle(of.where("node = cluster").join(into, "unit").select(F.col("node").alias("c"), "unit", "ref"))
        side = lambda k: heads.select(F.col("c").alias(k), F.col("unit").alias(f"g{k}"), F.col("ref").alias(f"r{k}"))
        now = links.join(side("a"), "a").join(side("b"), "b").where("ra = rb").select("a", "b", "ga", "gb", "score")
        new = settle(cluster(now).select(F.col("node").alias("c"), F.col("cluster").alias("to")))
        goes = heads.join(new, "c", "left").select("c", F.coalesce("to", "c").alias("to"), "ref")
        goes = settle(goes)
        of = settle(of.join(goes.withColumnRenamed("c", "cluster"), "cluster").select("node", F.col("to").alias("cluster"), F.col("ref").alias("unit")))
        for c in ("a", "b"):
            links = links.join(goes.select(F.col("c").alias(c), "to"), c).withColumn(c, F.col("to")).drop("to")
        links = settle(links.where("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("score").alias("score")))
    return of.select("node", "cluster")
