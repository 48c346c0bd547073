"""Regions: hits that compete for a place on a contig, and paths between core clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .intervals import measured, overlap_join


def suppress_competitors(hits: DataFrame, width: int, same_cluster: float = 0.3, other: float = 0.45, near: float = 0.98, pid_gap: float = 5) -> DataFrame:
    """The hits that survive their overlapping competitors on the contig.

    hits: contig, start, stop, name, cluster, bits, pid, size (of the cluster), best (best hit of its cluster).
    Overlap is the larger share of the two lengths. Within a cluster the lower bits lose (then the larger name). Between
    clusters a hit of at most near x the other's bits loses its place, and is weak if its cluster is a singleton, at most a
    tenth of the other's, or its identity is pid_gap lower. A hit survives with its place, or as its cluster's best if it is
    not weak. All pairs count; the outcome doesn't depend on their order.
    """
    hits, width = measured(hits, width)
    p = overlap_join(hits, hits, width).where("l_name <> r_name")
    o = F.least("l_stop", "r_stop") - F.greatest("l_start", "r_start") + 1
    share = o / F.least(F.col("l_stop") - F.col("l_start") + 1, F.col("r_stop") - F.col("r_start") + 1)
    twin = (F.col("l_cluster") == F.col("r_cluster")) & (share > same_cluster) & ((F.col("l_bits") < F.col("r_bits")) | ((F.col("l_bits") == F.col("r_bits")) & (F.col("l_name") > F.col("r_name"))))
    rival = (F.col("l_cluster") != F.col("r_cluster")) & (share > other) & (F.col("l_bits") <= near * F.col("r_bits"))
    weak = twin | (rival & ((F.col("l_size") == 1) | (F.col("l_size") * 10 <= F.col("r_size")) | (F.col("l_pid") + pid_gap <= F.col("r_pid"))))
    lost = p.where(twin | rival).groupBy(F.col("l_name").alias("name")).agg(F.max(weak).alias("weak"))
    j = hits.join(lost, "name", "left")
    return j.where(F.col("weak").isNull() | (F.col("best") & ~F.col("weak"))).select(*hits.columns)


def island_paths(features: DataFrame, core: DataFrame, order: list[str]) -> DataFrame:
    """left, right, path, genomes, n: each way of going from a core cluster to the next through others, and who takes it.

    A genome's path is its list of clusters between neighbouring core clusters, so no walk over the graph is needed: lists
    are equal or not. features: contig, genome, cluster; core: cluster.
    """
    f = features.join(core.select("cluster", F.lit(True).alias("_core")), "cluster", "left")
    w = Window.partitionBy("contig").orderBy(*order)
    f = f.withColumn("_k", F.count("_core").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_at", F.row_number().over(w))
    runs = f.groupBy("contig", "genome", "_k").agg(F.array_sort(F.collect_list(F.struct("_at", "cluster"))).alias("m")).where("_k > 0")
    heads = Window.partitionBy("contig").orderBy("_k")
    left = F.get("m", F.lit(0))["cluster"]
    runs = runs.withColumn("left", left).withColumn("right", F.lead(left).over(heads)).where("right is not null")
    path = F.array_join(F.transform(F.slice("m", 2, F.greatest(F.size("m") - 1, F.lit(0))), lambda x: x["cluster"]), ",")
    return runs.groupBy("left", "right", path.alias("path")).agg(F.countDistinct("genome").alias("genomes"), F.count(F.lit(1)).alias("n"))
