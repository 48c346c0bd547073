"""Thinning of a genome list by distances to medians, group by group."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import settle
from .order import gap_groups


def median_partition(nodes: DataFrame, distances: DataFrame, redundant: float, max_rounds: int = 200) -> DataFrame:
    """node, grp: representatives of a list of nodes (node, place), with the path of groups that led to each.

    The middle node of a group, by place, represents it; nodes at most `redundant` from it go. The others, sorted by
    their distance from it, fall into new groups where a gap is larger than `redundant` or a group would span more than
    twice that, and every new group is treated alike. distances: a, b, distance, either way round; pairs that are not there count as 1.

    A round treats all groups at once, as joins and windows by group; rounds are checkpointed.
    """
    pair = distances.select("a", "b", "distance")
    pair = settle(pair.union(pair.select("b", "a", "distance")).toDF("median", "node", "distance"))
    todo = settle(nodes.select("node", F.col("place").cast("long").alias("place"), F.lit("1").alias("parent")))
    found = None
    for _ in range(max_rounds):
        w = Window.partitionBy("parent")
        ranked = todo.withColumn("_at", F.row_number().over(w.orderBy("place", "node")) - 1).withColumn("_n", F.count(F.lit(1)).over(w))
        medians = settle(ranked.where(F.col("_at") == F.floor(F.col("_n") / 2)).select("parent", F.col("node").alias("median")))
        mine = medians.select(F.col("median").alias("node"), F.col("parent").alias("grp"))
        found = mine if found is None else found.union(mine)
        rest = todo.join(medians, "parent").where("node <> median").join(pair, ["median", "node"], "left")
        rest = rest.withColumn("distance", F.coalesce("distance", F.lit(1.0))).where(F.col("distance") > redundant)
        grouped = gap_groups(rest.select("parent", "node", "place", "distance"), "parent", "distance", redundant)
        number = F.dense_rank().over(Window.partitionBy("parent").orderBy("run", "grp"))
        order = F.row_number().over(Window.partitionBy("parent").orderBy("distance", "place", "node"))
        todo = settle(grouped.select("node", order.cast("long").alias("place"), F.concat_ws("_", "parent", number.cast("string")).alias("parent")))
        if todo.isEmpty():
            return found
    raise RuntimeError(f"groups are left after {max_rounds} rounds")


#: Fixed value: a target rank is rounded down after this is added.
ROUNDING = 0.499


def spaced_representatives(distances: DataFrame, quota: int, gap: float) -> DataFrame:
    """type, node, distance: of each type's nodes, farther than `gap` from it, about `quota` spread evenly along the sorted distances.

    The i-th of n nodes by distance is taken if it has come to the target rank, the end of one of `quota` equal slices (the last node
    stands for targets beyond it), and lies more than `gap` beyond the one taken before; the next target is the first after it.
    distances: type, node, distance. A fold over each type's sorted array, a genome list, in the JVM.
    """
    lists = distances.where(F.col("distance") > gap).groupBy("type").agg(F.array_sort(F.collect_list(F.struct(F.col("distance").cast("double").alias("distance"), "node"))).alias("m"))
    n = F.size("m")
    target = lambda s: F.least(F.floor(s * n / quota + ROUNDING) - 1, n - 1).cast("long")
    numbered = F.transform("m", lambda x, i: F.struct(i.cast("long").alias("i"), x["distance"].alias("distance"), x["node"].alias("node")))
    begin = F.struct(F.greatest(target(F.lit(1)), F.lit(0).cast("long")).alias("target"), F.lit(0.0).alias("last"), F.slice(numbered, 1, 0).alias("took"))

    def walk(state: Column, x: Column) -> Column:
        takes = (x["i"] >= state["target"]) & (x["distance"] - state["last"] > gap)
        after = target(F.ceil((x["i"] + 2 - ROUNDING) * quota / n))
        taken = F.struct(after.alias("target"), x["distance"].alias("last"), F.array_append(state["took"], x).alias("took"))
        return F.when(takes, taken).otherwise(state)

    return lists.select("type", F.explode(F.aggregate(numbered, begin, walk, lambda s: s["took"])).alias("x")).select("type", "x.node", "x.distance")


def farthest_representatives(nodes: DataFrame, first: DataFrame, distances: DataFrame | Callable[[DataFrame], DataFrame], redundant: float, quit: float, stop_mean: float, stop_least: float, most: int, at_once: int, stop_new: int = 0) -> DataFrame:
    """node, state, representative, identity, round: representatives added in rounds until the others are near enough to one.

    nodes: node, place; first: node, number (from 0), the first representatives; distances: a, b, distance, either way round, pairs that are not there
    count as 1, or a function that gives those of a few nodes (a) to all others, so that no table of all pairs is made; identity is 100 (1 - distance). Each round joins the others with the new representatives only and keeps a running nearest one, the
    earlier at a tie. Those with an identity of `redundant` or more to any are redundant and go. Of each representative's others the
    farthest one (the first by place at a tie) may become one, the farthest of all first, as long as its identity is below `quit`; at most as many as there are
    representatives, `at_once`, and up to `most` in all. When the mean or the least identity to the nearest has come to its stop, stop_new or
    fewer were added, or none but redundant ones are left, the last ones are joined and it ends. States: representative, redundant (with the first one that
    it is redundant to), covered. Rounds are written; what comes to the driver is one row of numbers a round.
    """
    if callable(distances):
        near_to = lambda new: distances(new.select(F.col("rep").alias("a"))).select(F.col("a").alias("rep"), F.col("b").alias("node"), F.col("distance").alias("d"))
    else:
        pair = settle(distances.select("a", "b", "distance").union(distances.select("b", "a", "distance")).groupBy(F.col("a").alias("rep"), F.col("b").alias("node")).agg(F.min("distance").alias("d")))
        near_to = lambda new: pair
    identity = lambda d: F.round(100 * (1 - d), 9)
    new = settle(first.select(F.col("node").alias("rep"), F.col("number").cast("long").alias("number"), F.lit(None).cast(nodes.schema["node"].dataType).alias("of"), F.lit(None).cast("double").alias("d")))
    rest = settle(nodes.select("node", "place").join(new.select(F.col("rep").alias("node")), "node", "left_anti").withColumn("near", F.lit(None).cast("struct<d:double,number:long>")))
    found = [new.select("rep", "number", "of", "d", F.lit(0).alias("round"))]
    gone, total, last, n = [], new.count(), False, 0
    while True:
        n += 1
        met = rest.select("node").join(near_to(new), "node").join(new.select("rep", "number"), "rep")
        nearest = met.groupBy("node").agg(F.min(F.struct(F.col("d").cast("double").alias("d"), "number")).alias("x"), F.min(F.when(identity(F.col("d")) >= redundant, F.struct("number", F.col("d").cast("double").alias("d")))).alias("hit"))
        least = new.agg(F.min("number")).first()[0]
        unseen = F.struct(F.lit(1.0).alias("d"), F.lit(least).cast("long").alias("number"))  # a pair that is not there counts as 1
        now = rest.join(nearest, "node", "left").select("node", "place", F.least(F.coalesce("near", unseen), F.coalesce("x", unseen)).alias("near"), "hit") if least is not None else rest.withColumn("hit", F.lit(None).cast("struct<number:long,d:double>"))
        now = settle(now)
        gone.append(now.where("hit is not null").select("node", F.col("hit.number").alias("number"), F.col("hit.d").alias("d"), F.lit(n).alias("round")))
        rest = now.where("hit is null").select("node", "place", "near")
        s = now.agg(F.count(F.lit(1)).alias("all"), F.sum(F.when(F.col("hit").isNotNull(), 1).otherwise(0)).alias("redundant"), F.avg(F.when(F.col("hit").isNull(), identity(F.col("near.d")))).alias("mean"), F.min(F.when(F.col("hit").isNull(), identity(F.col("near.d")))).alias("least")).first()
        if last or s["all"] == (s["redundant"] or 0):
            break
        far = rest.groupBy("near.number").agg(F.max(F.struct(F.col("near.d").alias("d"), (-F.col("place")).alias("p"), "node")).alias("x"))
        room = max(0, min(most - total, total, at_once))
        chosen = far.where(identity(F.col("x.d")) < quit).orderBy(F.col("x.d").desc(), "number").limit(room)
        chosen = settle(chosen.select(F.col("x.node").alias("rep"), F.col("number").alias("of_number"), F.col("x.d").alias("d")))  # at_once rows at most
        order = Window.orderBy(F.col("d").desc(), "of_number")
        known = reduce(DataFrame.unionByName, found).select(F.col("number").alias("of_number"), F.col("rep").alias("of"))
        new = settle(chosen.withColumn("number", (F.row_number().over(order) - 1 + total).cast("long")).join(known, "of_number").select("rep", "number", "of", "d"))
        found.append(new.select("rep", "number", "of", "d", F.lit(n).alias("round")))
        added = new.count()
        total += added
        rest = settle(rest.join(new.select(F.col("rep").alias("node")), "node", "left_anti"))
        last = s["mean"] >= stop_mean or s["least"] >= stop_least or added <= stop_new or added + (s["redundant"] or 0) == s["all"] or total >= most
    reps = reduce(DataFrame.unionByName, found)
    names = reps.select("number", F.col("rep").alias("representative"))
    out = reps.select(F.col("rep").alias("node"), F.lit("representative").alias("state"), F.col("of").alias("representative"), identity(F.col("d")).alias("identity"), "round")
    lost = reduce(DataFrame.unionByName, gone).join(names, "number").select("node", F.lit("redundant").alias("state"), "representative", identity(F.col("d")).alias("identity"), "round")
    near = rest.select("node", F.col("near.number").alias("number"), F.col("near.d").alias("d")).join(names, "number").select("node", F.lit("covered").alias("state"), "representative", identity(F.col("d")).alias("identity"), F.lit(n).alias("round"))
    return out.unionByName(lost).unionByName(near)
