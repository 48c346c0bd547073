"""Intervals on contigs: overlap joins by bins, unions, containment, differences of annotations.

Intervals are rows (contig, start, stop), both ends inclusive. An overlap join explodes both
sides to bins and joins on (contig, bin): no pair is met twice, since only the first bin that both share counts,
and a contig with very many intervals spreads over its bins.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from .graph import settle


def overlap_join(left: DataFrame, right: DataFrame, width: int) -> DataFrame:
    """Pairs that overlap; columns of the sides get the prefixes l_ and r_, contig stays. width: near the usual length."""
    binned = lambda df, p: df.select(
        "contig", *(F.col(c).alias(p + c) for c in df.columns if c != "contig"), F.floor(F.col("start") / width).alias(p + "bin0"), F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("stop") / width))).alias("bin")
    )
    j = binned(left, "l_").join(binned(right, "r_"), ["contig", "bin"])
    return j.where("l_start <= r_stop and r_start <= l_stop and bin = greatest(l_bin0, r_bin0)").drop("bin", "l_bin0", "r_bin0")


#: Bins are at most so many times as wide as asked for.
WIDEST = 16


def measured(intervals: DataFrame, width: int) -> tuple[DataFrame, int]:
    """The intervals, written once, and a width of bins for them: twice their mean length, from `width` to WIDEST times that, so that an interval lies in few bins."""
    seen = Observation()
    got = settle(intervals.observe(seen, F.avg(F.col("stop") - F.col("start") + 1).alias("mean")))
    return got, int(min(max(2 * (seen.get["mean"] or 0), width), WIDEST * width))


def overlap_share() -> Column:
    """Mean of the overlap's shares of both lengths."""
    o = F.least("l_stop", "r_stop") - F.greatest("l_start", "r_start") + 1
    return (o / (F.col("l_stop") - F.col("l_start") + 1) + o / (F.col("r_stop") - F.col("r_start") + 1)) / 2


def _mutual(left: DataFrame, right: DataFrame, width: int, least: float) -> DataFrame:
    """As mutual_overlaps gives them, of tables that are read twice.

    The pairs of a bin are added up to the best of each name where they are made, so names and shares of these are shuffled, not pairs; both
    ways need the same columns of the sides, so the bins are shuffled once.
    """
    keys = ["contig", "name", "start", "stop"]
    p = overlap_join(left.select(*keys), right.select(*keys), width).select("l_name", "r_name", F.round(overlap_share(), 9).alias("share")).where(F.col("share") >= least)
    best = lambda a, b: p.groupBy(a).agg(F.min(F.struct((-F.col("share")).alias("minus"), b)).alias("m"))
    one = best("l_name", "r_name").select("l_name", F.col("m.r_name").alias("r_name"), (-F.col("m.minus")).alias("share"))
    two = best("r_name", "l_name").select(F.col("m.l_name").alias("_l"), F.col("r_name").alias("_r"))
    return one.join(two, F.col("l_name").eqNullSafe(F.col("_l"))).where(F.col("r_name").eqNullSafe(F.col("_r"))).drop("_l", "_r")


def mutual_overlaps(left: DataFrame, right: DataFrame, width: int, least: float = 0.5) -> DataFrame:
    """l_name, r_name, share: pairs that are each other's best overlap of at least the share; ties by name. Both sides need `name`, once on a side. Bins are as wide as `measured` finds for either side."""
    (left, one), (right, two) = measured(left, width), measured(right, width)
    return _mutual(left, right, max(one, two), least)


def annotation_difference(old: DataFrame, new: DataFrame, width: int, least: float = 0.5) -> DataFrame:
    """old_name, new_name, difference: SAME, DIFF_5P, DIFF_3P, BOTH, with _INVERT where strands differ (INVERT for SAME), NEW, REMOVED.

    The sides, a name once on each, are written once, as each is read several times; one join of either with the names of the mutual pairs gives what both have and what only one has.
    """
    (old, one), (new, two) = measured(old, width), measured(new, width)
    met = _mutual(old, new, max(one, two), least).select(F.col("l_name").alias("_l"), F.col("r_name").alias("_r"))
    side = lambda df, p: df.select(*(F.col(c).alias(p + c) for c in ("name", "start", "stop", "orient")), F.lit(True).alias(p + "here"))
    left = side(old, "l_").join(met, F.col("l_name") == F.col("_l"), "left").drop("_l").withColumn("_k", F.xxhash64(F.coalesce("_r", "l_name")))  # deals those without a mate, too
    both = left.join(side(new, "r_").withColumn("_n", F.xxhash64("r_name")), (F.col("_k") == F.col("_n")) & (F.col("_r") == F.col("r_name")), "full")
    kind = F.when((F.col("l_start") == F.col("r_start")) & (F.col("l_stop") == F.col("r_stop")), "SAME").when((F.col("l_start") != F.col("r_start")) & (F.col("l_stop") != F.col("r_stop")), "BOTH")
    kind = kind.when(F.col("l_start") != F.col("r_start"), "DIFF_5P").otherwise("DIFF_3P")
    turned = F.col("l_orient") != F.col("r_orient")
    kind = F.when(turned & (kind == "SAME"), "INVERT").when(turned, F.concat(kind, F.lit("_INVERT"))).otherwise(kind)
    kind = F.when(F.col("r_here").isNull(), "REMOVED").when(F.col("l_here").isNull(), "NEW").otherwise(kind)
    return both.select(F.col("l_name").alias("old_name"), F.col("r_name").alias("new_name"), kind.alias("difference"))


def union(intervals: DataFrame, touching: bool = True) -> DataFrame:
    """contig, start, stop, n: overlapping (and touching) intervals as one."""
    w = Window.partitionBy("contig").orderBy("start", "stop")
    before = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col("start") > before + int(touching)), 1).otherwise(0)
    run = F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return intervals.withColumn("new", new).withColumn("run", run).groupBy("contig", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.count(F.lit(1)).alias("n")).drop("run")


def covered(intervals: DataFrame, lengths: DataFrame) -> DataFrame:
    """contig, percent of its length that intervals cover. lengths: contig, length; contigs without intervals: 0."""
    n = union(intervals).groupBy("contig").agg(F.sum(F.col("stop") - F.col("start") + 1).alias("n"))
    return lengths.join(n, "contig", "left").select("contig", (F.coalesce("n", F.lit(0)) * 100 / F.col("length")).alias("percent"))


def drop_contained(intervals: DataFrame) -> DataFrame:
    """Intervals not contained in another of the contig; of equal ones the first by name stays."""
    w = Window.partitionBy("contig").orderBy("start", F.col("stop").desc(), "name").rowsBetween(Window.unboundedPreceding, -1)
    return intervals.withColumn("_max", F.max("stop").over(w)).where("_max is null or stop > _max").drop("_max")


def resolve_conflicts(intervals: DataFrame, priority: list[str], width: int, least: int = 1) -> DataFrame:
    """Intervals that lose against no overlapping one of the contig: higher priority columns win in turn, then the smaller name."""
    intervals, width = measured(intervals, width)
    rank = lambda p: F.struct(*(F.col(p + c) for c in priority), (-F.col(p + "name")).alias("minus"))
    pairs = overlap_join(intervals, intervals, width).where("l_name <> r_name").where(F.least("l_stop", "r_stop") - F.greatest("l_start", "r_start") + 1 >= least)
    losers = pairs.where(rank("l_") < rank("r_")).select(F.col("l_name").alias("name")).distinct()
    return intervals.join(losers, "name", "left_anti").select(*intervals.columns)


def trim_by_priority(intervals: DataFrame, priority: str, width: int) -> DataFrame:
    """contig, name, priority, start, stop: intervals cut so that none overlap: a place belongs to the interval of the least priority there, then the earlier start, then the smaller name.

    Of an interval's pieces the longest stays, then the first; one that owns no place goes. A sweep along each contig holds the intervals
    that are open there and no pairs, so width, the bins of a join, isn't needed any more.
    """
    kinds = intervals.schema
    columns = ["contig", "start", "stop", "name", priority]

    def owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, at = None, 0
        held: list[tuple] = []  # the first owns the places from `at` on
        out: list[tuple] = []

        def close(before: int | None) -> None:
            nonlocal at
            while held and (before is None or held[0][-1] < before):
                stop, name, kind = held[0][-1], held[0][3], held[0][1]
                out.append((here, at, stop, name, kind))
                at = stop + 1
                while held and held[0][-1] < at:
                    heapq.heappop(held)

        for b in batches:
            types = b.schema.types
            for contig, start, stop, name, kind in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if contig != here:
                    close(None)
                    here = contig
                close(start)
                new = (kind is not None, kind, start, name, stop)
                if not held:
                    at = start
                elif new < held[0] and at < start:
                    out.append((here, at, start - 1, held[0][3], held[0][1]))
                    at = start
                heapq.heappush(held, new)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], types[k]) for k in range(5)], columns)
            out.clear()
        close(None)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], types[k]) for k in range(5)], columns)

    rows = intervals.where("contig is not null and start <= stop").select(*columns).repartition("contig").sortWithinPartitions("contig", "start", "stop")
    won = rows.mapInArrow(owners, ", ".join(f"`{c}` {kinds[c].dataType.simpleString()}" for c in columns))
    w = Window.partitionBy("contig", "name").orderBy("start")
    run = won.withColumn("_new", F.when(F.lag("stop").over(w) + 1 == F.col("start"), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(w))
    pieces = run.groupBy("contig", "name", priority, "_run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    longest = pieces.groupBy("contig", "name", priority).agg(F.max_by(F.struct("start", "stop"), F.struct(F.col("stop") - F.col("start"), -F.col("start"))).alias("m"))
    return longest.select("contig", "name", priority, "m.start", "m.stop")


def merge_runs(intervals: DataFrame, kind: str) -> DataFrame:
    """contig, kind, start, stop, n: neighbours of one kind along the contig as one range, the gaps between them included."""
    w = Window.partitionBy("contig").orderBy("start", "stop", "name")
    change = F.when(F.lag(kind).over(w).eqNullSafe(F.col(kind)), 0).otherwise(1)
    run = F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return intervals.withColumn("_c", change).withColumn("_run", run).groupBy("contig", "_run", kind).agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.count(F.lit(1)).alias("n")).drop("_run")


def intersects(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return (a0 <= b1) & (b0 <= a1)


def proximal(a0: Column, a1: Column, b0: Column, b1: Column, distance: int) -> Column:
    """Whether two ranges are at most the distance apart."""
    return (a0 <= b1 + distance) & (b0 <= a1 + distance)
