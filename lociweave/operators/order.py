"""Order of features on contigs: positions, neighbours, oriented adjacency.

Features are rows (feat, contig, cluster, genome, orient 1 or -1) and a sort key. Contigs are the
windows' partitions; a genome has many, so they spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import settle


def positions(features: DataFrame, contig: list[str], order: list[str], name: str = "pos") -> DataFrame:
    """The place of each feature on its contig, from 1."""
    return features.withColumn(name, F.row_number().over(Window.partitionBy(*contig).orderBy(*order)).cast("long"))


def neighbours(features: DataFrame, contig: list[str], order: list[str], value: str) -> DataFrame:
    """previous and next value along the contig."""
    w = Window.partitionBy(*contig).orderBy(*order)
    return features.withColumns({"previous": F.lag(value).over(w), "next": F.lead(value).over(w)})


def qualifying(features: DataFrame, cluster_sizes: DataFrame, at_least: int) -> DataFrame:
    """Features whose cluster has at least so many genomes. cluster_sizes: cluster, n_genomes."""
    return features.join(cluster_sizes.where(F.col("n_genomes") >= at_least).select("cluster"), "cluster", "left_semi")


def numbered(rows: DataFrame, *key: str) -> DataFrame:
    """The rows with k, from 1 in the order of the key, which should be unique.

    Ranges are cut once and checkpointed; numbers come from their counts (one row a range), not from one sort of all rows in a task.
    """
    ranged = settle(rows.repartitionByRange(*key).withColumn("_part", F.spark_partition_id()))
    per = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = per.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*key))
    return ranged.withColumn("_own", own).join(F.broadcast(before), "_part").withColumn("k", (F.col("_own") + F.col("_before")).cast("long")).drop("_part", "_own", "_before")


def circular_neighbours(features: DataFrame, circular: Column, order: list[str], value: str = "cluster") -> DataFrame:
    """The features with `previous` and `next`; on circular contigs the first follows the last. Filter to qualifying features first."""
    w = Window.partitionBy("contig").orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wraps = circular & (F.count(F.lit(1)).over(whole) > 1)
    around = lambda near, end: F.coalesce(near(value).over(w), F.when(wraps, end(value).over(whole)))
    return features.withColumns({"previous": around(F.lag, F.last), "next": around(F.lead, F.first)})


def _end(orient: Column, forward: int, backward: int) -> Column:
    return F.when(orient == 1, forward).otherwise(backward)


def adjacency(features: DataFrame, circular: Column, order: list[str]) -> DataFrame:
    """c1, e1, c2, e2, genome: the facing ends (5 or 3) of neighbours; circular contigs of two or more features wrap.

    Filter to qualifying features first. The smaller end comes first.
    """
    w = Window.partitionBy("contig").orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    me = F.struct("cluster", _end(F.col("orient"), 3, 5).alias("end"))
    facing = F.struct("cluster", _end(F.col("orient"), 5, 3).alias("end"))
    nxt = F.coalesce(F.lead(facing).over(w), F.when(circular & (F.count(F.lit(1)).over(whole) > 1), F.first(facing).over(whole)))
    pair = features.select("genome", me.alias("a"), nxt.alias("b")).where("b is not null")
    low, high = F.least("a", "b"), F.greatest("a", "b")
    pair = pair.select("genome", low.alias("a"), high.alias("b"))
    return pair.select(F.col("a.cluster").alias("c1"), F.col("a.end").alias("e1"), F.col("b.cluster").alias("c2"), F.col("b.end").alias("e2"), "genome")


def edge_weights(edges: DataFrame) -> DataFrame:
    """c1, e1, c2, e2, weight: genomes with the edge."""
    return edges.groupBy("c1", "e1", "c2", "e2").agg(F.countDistinct("genome").alias("weight"))


def both_ways(weights: DataFrame) -> DataFrame:
    back = weights.select(F.col("c2").alias("c1"), F.col("e2").alias("e1"), F.col("c1").alias("c2"), F.col("e1").alias("e2"), "weight")
    return weights.union(back.where("c1 <> c2 or e1 <> e2"))


def best_edges(weights: DataFrame, cluster_sizes: DataFrame) -> DataFrame:
    """The best edge of each cluster end: weight, then size of the neighbour, then its smaller id and end."""
    n = cluster_sizes.select(F.col("cluster").alias("c2"), F.col("n_genomes").alias("size"))
    w = Window.partitionBy("c1", "e1").orderBy(F.col("weight").desc(), F.col("size").desc(), "c2", "e2")
    return both_ways(weights).join(n, "c2").withColumn("_r", F.row_number().over(w)).where("_r = 1").select("c1", "e1", "c2", "e2", "weight")


def mutual_edges(best: DataFrame) -> DataFrame:
    """Best edges that are best from both ends, once."""
    back = best.select(F.col("c2").alias("c1"), F.col("e2").alias("e1"), F.col("c1").alias("c2"), F.col("e1").alias("e2"))
    return best.join(back, ["c1", "e1", "c2", "e2"], "left_semi").where(F.struct("c1", "e1") <= F.struct("c2", "e2"))


def core_edges(weights: DataFrame, genomes: int, percent: float) -> DataFrame:
    return weights.where(F.col("weight") * 100 / genomes >= percent)


def breaks(weights: DataFrame) -> DataFrame:
    """cluster, breaks: how many more neighbours than one each end has, both ends together."""
    ends = both_ways(weights).groupBy("c1", "e1").agg((F.count(F.lit(1)) - 1).alias("more"))
    return ends.groupBy(F.col("c1").alias("cluster")).agg(F.sum("more").alias("breaks"))


def edge_vectors(edges: DataFrame, genomes: list) -> DataFrame:
    """c1, e1, c2, e2, vector: a 0 or 1 for each listed genome."""
    got = edges.groupBy("c1", "e1", "c2", "e2").agg(F.collect_set("genome").alias("gs"))
    bits = F.concat(*(F.when(F.array_contains("gs", g), "1").otherwise("0") for g in genomes))
    return got.select("c1", "e1", "c2", "e2", bits.alias("vector"))


def nearest_core(features: DataFrame, is_core: Column, order: list[str]) -> DataFrame:
    """For each feature the nearest core cluster before and after it on its contig, with the number of steps."""
    w = Window.partitionBy("contig").orderBy(*order)
    at = F.row_number().over(w)
    core = F.when(is_core, F.struct("cluster", F.col("_at").alias("at")))
    f = features.withColumn("_at", at).withColumn("_core", core)
    before = F.last("_core", True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("_core", True).over(w.rowsBetween(1, Window.unboundedFollowing))
    f = f.withColumns({"_b": before, "_a": after})
    return f.select(*features.columns, F.col("_b.cluster").alias("core_before"), (F.col("_at") - F.col("_b.at")).alias("steps_before"), F.col("_a.cluster").alias("core_after"), (F.col("_a.at") - F.col("_at")).alias("steps_after"))


def bigram_probability(rows: DataFrame, key: list[str], order: list[str], value: str) -> DataFrame:
    """previous, value, n, probability: counts of (previous, value) with one added, over those of previous; the first row follows the last."""
    w = Window.partitionBy(*key).orderBy(*order)
    last = F.last(value).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    pairs = rows.select(F.coalesce(F.lag(value).over(w), last).alias("previous"), F.col(value).alias("value"))
    kinds = rows.select(value).distinct().count()
    n = pairs.groupBy("previous", "value").agg(F.count(F.lit(1)).alias("n"))
    of = pairs.groupBy("previous").agg(F.count(F.lit(1)).alias("total"))
    return n.join(of, "previous").select("previous", "value", "n", ((F.col("n") + 1) / (F.col("total") + kinds)).alias("probability"))


def neighbour_conservation(features: DataFrame, order: list[str]) -> DataFrame:
    """cluster, conserved: the most members whose previous (and next) neighbours share a cluster, added up for both sides."""
    n = neighbours(features, ["contig"], order, "cluster")
    sides = n.select("cluster", F.explode(F.array(F.struct(F.lit("p").alias("side"), F.col("previous").alias("nbr")), F.struct(F.lit("n").alias("side"), F.col("next").alias("nbr")))).alias("x")).where("x.nbr is not null")
    most = sides.groupBy("cluster", "x.side", "x.nbr").agg(F.count(F.lit(1)).alias("n")).groupBy("cluster", "side").agg(F.max("n").alias("n"))
    return most.groupBy("cluster").agg(F.sum("n").alias("conserved"))


def split_genes(hits: DataFrame, most: float = 0.2) -> DataFrame:
    """contig, cluster, first, second: neighbouring hits of a cluster on a contig whose query parts overlap by at most the share of the shorter.

    hits: contig, cluster, at, name, qstart, qend. The first hit is compared with the last, and the last with none before it.
    """
    w = Window.partitionBy("contig", "cluster").orderBy("at", "name")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    me = F.struct("name", "qstart", "qend")
    h = hits.withColumn("_r", F.row_number().over(w)).withColumn("_n", F.count(F.lit(1)).over(whole))
    h = h.withColumn("_p", F.coalesce(F.lag(me).over(w), F.last(me).over(whole))).where("_n > 1 and (_r < _n or _n = 2 and _r = 1)")
    overlap = F.least("qend", "_p.qend") - F.greatest("qstart", "_p.qstart") + 1
    shorter = F.least(F.col("qend") - F.col("qstart") + 1, F.col("_p.qend") - F.col("_p.qstart") + 1)
    return h.where(F.greatest(overlap, F.lit(0)) <= most * shorter).select("contig", "cluster", F.col("_p.name").alias("first"), F.col("name").alias("second"))


def gap_groups(rows: DataFrame, key: str, value: str, gap: float) -> DataFrame:
    """The rows with `grp`: along the value a new group begins after a gap larger than `gap`, or when the group would span more than twice it.

    Where a group begins depends on where the last began, so a fold runs over each run that the gap
    condition alone (a window) leaves together; runs, not keys, are the groups of the fold.
    """
    w = Window.partitionBy(key).orderBy(value)
    run = F.sum(F.when(F.col(value) - F.lag(value).over(w) > gap, 1).otherwise(0)).over(w)
    rows = rows.withColumn("_run", run)

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(parts)).sort_values(value, kind="stable")
        grp, start, out = 0, None, []
        for v in pdf[value]:
            if start is None or v - start > 2 * gap:
                grp, start = grp + 1, v
            out.append(grp)
        yield pdf.assign(grp=out).drop(columns="_run").assign(run=pdf["_run"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_run") + ", grp int, run long"
    return rows.groupBy(key, "_run").applyInPandas(lambda pdf: next(fold(iter([pdf]))), schema)


def low_coverage(coverage: DataFrame, least: int) -> DataFrame:
    """contig, start, stop: the stretches between positions of enough coverage. coverage: contig, position, coverage, length."""
    high = coverage.where(F.col("coverage") >= least)
    w = Window.partitionBy("contig").orderBy("position")
    gaps = high.select("contig", (F.coalesce(F.lag("position").over(w), F.lit(0)) + 1).alias("start"), (F.col("position") - 1).alias("stop"))
    ends = coverage.groupBy("contig").agg(F.max("length").alias("length"), F.max(F.when(F.col("coverage") >= least, F.col("position"))).alias("last"))
    tail = ends.select("contig", (F.coalesce("last", F.lit(0)) + 1).alias("start"), F.col("length").alias("stop"))
    return gaps.union(tail).where("start <= stop")
