"""Chains of best edges: where walks along them end, and bubbles between two chains that are collapsed into one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import settle

def _end(cluster: str, end: str) -> Column:
    return F.struct(F.col(cluster).alias("cluster"), F.col(end).cast("int").alias("end"))


def _across(x: Column) -> Column:
    """The other end of an end's cluster."""
    return F.struct(x["cluster"].alias("cluster"), (8 - x["end"]).cast("int").alias("end"))


def reaches(mutual: DataFrame) -> DataFrame:
    """x, loose, steps, low, high: where a walk that leaves a cluster by its end x, and each next one by the end that it wasn't entered by, comes to an end without an edge.

    mutual: x, y, weight, both ways, one y an x. steps: edges; low and high: least and largest weight, null without edges. Both ends of clusters with
    an edge are given; walks in circles are left out. Each end knows an end further along, and every round doubles how far by a join:
    a chain of n clusters takes log n rounds, and no task holds one.
    """
    ends = mutual.select(F.explode(F.array("x", _across(F.col("x")))).alias("x")).distinct()
    out = ends.join(mutual, "x", "left")
    at = F.when(F.col("y").isNull(), F.col("x")).otherwise(_across(F.col("y")))
    out = out.select("x", at.alias("at"), F.when(F.col("y").isNull(), 0).otherwise(1).cast("long").alias("steps"), F.col("weight").alias("low"), F.col("weight").alias("high"), F.col("y").isNull().alias("done"))
    out, far, n = settle(out), 1, None
    while True:
        ahead = out.select(F.col("x").alias("at"), F.col("at").alias("at2"), F.col("steps").alias("steps2"), F.col("low").alias("low2"), F.col("high").alias("high2"), F.col("done").alias("done2"))
        moved = out.where("not done").join(ahead, "at")
        moved = moved.select("x", F.col("at2").alias("at"), (F.col("steps") + F.col("steps2")).alias("steps"), F.least("low", "low2").alias("low"), F.greatest("high", "high2").alias("high"), F.col("done2").alias("done"))
        out = settle(out.where("done").unionByName(moved))
        far *= 2
        n = n or out.count()
        if far > n or out.where("not done").isEmpty():  # what is not done after as many steps as there are ends goes in circles
            return out.where("done").select("x", F.col("at").alias("loose"), "steps", "low", "high")


def bubbles(best: DataFrame, mutual: DataFrame, used: DataFrame) -> DataFrame:
    """x, p, q, weight, old: joins p to q that collapse the bubbles which begin at loose ends x, the first one of each chain; old: what q was joined to.

    A bubble: the best edge of a chain's loose end x leads into another chain, which on the side of that edge has a loose end whose best
    edge leads back into the first, on x's side. The two stretches overlap; the one with the larger sum of least and largest weight is kept,
    the first at a tie. Bubbles that share a chain wait for the one with the smallest x. used: x, ends that began one already.
    """
    reach = settle(reaches(mutual))
    edge = best.select("x", F.col("y").alias("to"), "weight")
    known = mutual.select("x", F.lit(True).alias("on"))

    def follow(rows: DataFrame, c: str, end: str, k: int) -> DataFrame:
        """The best edge of end c, and the end and the weights of the walk on from there; a cluster without mutual edges ends the walk itself."""
        rows = rows.join(edge.select(F.col("x").alias(c), F.col("to").alias(f"to{k}"), F.col("weight").alias(f"w{k}")), c)
        on = reach.select(F.col("x").alias(f"to{k}"), F.col("loose").alias(end), F.col("low").alias(f"low{k}"), F.col("high").alias(f"high{k}"))
        rows = rows.join(on, f"to{k}", "left").join(known.withColumnRenamed("x", f"to{k}"), f"to{k}", "left")
        rows = rows.withColumn(end, F.coalesce(end, F.when(F.col("on").isNull(), F.col(f"to{k}")))).where(F.col(end).isNotNull()).drop("on")
        return rows

    start = reach.where("steps = 0").select("x").join(used, "x", "left_anti")
    found = follow(start, "x", "alt", 1).where("alt <> x")
    # the edge of x belongs to the stretch that the second walk follows back to x, and the other way round
    found = follow(found, "alt", "home", 2).where("home = x")
    total1, total2 = (F.least(w, low) + F.greatest(w, high) for w, low, high in (("w1", "low2", "high2"), ("w2", "low1", "high1")))
    first = total1 >= total2
    found = found.select("x", "alt", *(F.when(first, F.col(a)).otherwise(F.col(b)).alias(n) for a, b, n in (("x", "alt", "p"), ("to1", "to2", "q"), ("w1", "w2", "weight"))))
    far = reach.select("x", F.col("loose").alias("far"))
    for c in ("x", "alt"):  # a chain is known by the smaller of its two loose ends
        found = found.withColumn("_x", _across(F.col(c))).join(far.withColumnRenamed("x", "_x"), "_x", "left").withColumn(f"chain_{c}", F.least(F.col(c), F.coalesce("far", "_x"))).drop("_x", "far")
    found = settle(found)
    touched = found.select("x", F.explode(F.array("chain_x", "chain_alt")).alias("c")).groupBy("c").agg(F.min("x").alias("x"))
    for c in ("chain_x", "chain_alt"):
        found = found.join(touched.select(F.col("c").alias(c), "x"), [c, "x"], "left_semi")
    return found.join(mutual.select(F.col("x").alias("q"), F.col("y").alias("old")), "q", "left").select("x", "p", "q", "weight", "old")


def collapsed(best: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """c1, e1, c2, e2, weight: mutual best edges after bubbles were collapsed, the smaller end first.

    best: c1, e1, c2, e2, weight, the best edge of each cluster end. Rounds of bubbles of different chains; a collapse joins p to q, cuts q from what it was
    joined to, and makes p best for q, which may open further bubbles. An end begins one bubble at most, so the rounds come to an end.
    """
    best = settle(best.select(_end("c1", "e1").alias("x"), _end("c2", "e2").alias("y"), "weight"))
    mutual = settle(best.join(best.select(F.col("y").alias("x"), F.col("x").alias("y")), ["x", "y"], "left_semi").where("x.cluster <> y.cluster"))
    used = best.select("x").limit(0)
    for _ in range(max_rounds):
        done = settle(bubbles(best, mutual, used))
        if done.isEmpty():
            break
        gone = done.where("old is not null").select(F.explode(F.array("q", "old")).alias("x"))
        new = done.select(F.col("p").alias("x"), F.col("q").alias("y"), "weight").union(done.select("q", "p", "weight"))
        mutual = settle(mutual.join(gone, "x", "left_anti").unionByName(new))
        best = settle(best.join(done.select(F.col("q").alias("x")), "x", "left_anti").unionByName(done.select(F.col("q").alias("x"), F.col("p").alias("y"), "weight")))
        used = settle(used.union(done.select("x")))
    else:
        raise RuntimeError(f"bubbles are left after {max_rounds} rounds")
    return mutual.where("x < y").select(F.col("x.cluster").alias("c1"), F.col("x.end").alias("e1"), F.col("y.cluster").alias("c2"), F.col("y.end").alias("e2"), "weight")
