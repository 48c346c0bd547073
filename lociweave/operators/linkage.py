"""Trees from a table of distances, or from sets: linkage by rounds of mutual nearest clusters, and neighbour joining."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import settle
from .order import numbered

#: Pairs, rows of three numbers, that one task may go through.
FOLD_PAIRS = 500_000


def _joined(method: str, missing: float) -> Column:
    """The distance of two clusters from those of their parts: rows of d with the product w of sizes, in all whole; pairs of items that lack a row count as missing."""
    lacks = F.col("whole") - F.col("w")
    if method == "average":
        return F.round((F.col("sum") + lacks * missing) / F.col("whole"), 12)
    return {"complete": F.when(lacks > 0, F.greatest("most", F.lit(missing))).otherwise(F.col("most")), "single": F.col("least")}[method]


def _branch(label: str, length: Column) -> Column:
    return F.concat(F.col(label), F.lit(":"), F.format_string("%.6f", length))


def _rounds_folded(pairs: DataFrame, clusters: DataFrame, method: str, missing: float, done: int) -> DataFrame:
    """low, high, height, size, label, round: the merges that are left, by the same rounds over arrays in one task; only clusters that merge no further have a label.

    pairs: a, b, d, few enough to fold; clusters: those of pairs. The rounds are numbered on from done.
    """

    def fold(pairs: pd.DataFrame, clusters: pd.DataFrame) -> pd.DataFrame:
        clusters = clusters.sort_values("c", ignore_index=True)
        names, label = clusters["c"].to_numpy(), clusters["label"].tolist()
        size, height = clusters["size"].to_numpy(dtype="int64", copy=True), clusters["height"].to_numpy(dtype="float64", copy=True)
        a, b, d = np.searchsorted(names, pairs["a"].to_numpy()), np.searchsorted(names, pairs["b"].to_numpy()), pairs["d"].to_numpy(dtype="float64")
        out, n = [], done
        while len(a):
            n += 1
            rank = np.empty(len(a), dtype="int64")
            rank[np.lexsort((b, a, d))] = np.arange(len(a))
            best = np.full(len(names), len(a))
            for c in (a, b):
                np.minimum.at(best, c, rank)
            mutual = np.flatnonzero((best[a] == rank) & (best[b] == rank))
            was, to = size.copy(), np.arange(len(names))
            for x, y, z in zip(a[mutual].tolist(), b[mutual].tolist(), (d[mutual] / 2).tolist(), strict=True):
                label[x], label[y] = f"({label[x]}:{z - height[x]:.6f},{label[y]}:{z - height[y]:.6f})", None
                size[x], height[x], to[y] = size[x] + size[y], z, x
                out.append((x, y, z, size[x], n))
            w = was[a] * was[b]
            a, b = to[a], to[b]
            apart = a != b
            low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            d, w = d[apart], w[apart]
            key, of = np.unique(low * len(names) + high, return_inverse=True)
            a, b = key // len(names), key % len(names)
            lacks = size[a] * size[b] - np.bincount(of, w, len(key))
            if method == "average":
                d = np.round((np.bincount(of, d * w, len(key)) + lacks * missing) / (size[a] * size[b]), 12)
            else:
                end = np.full(len(key), np.inf if method == "single" else -np.inf)
                (np.minimum if method == "single" else np.maximum).at(end, of, d)
                d = np.where((lacks > 0) & (method == "complete"), np.maximum(end, missing), end)
        got = pd.DataFrame(out, columns=["low", "high", "height", "size", "round"])
        last = ~got["low"].duplicated(keep="last") & ~got["low"].isin(got["high"])
        got["label"] = [label[x] if final else None for x, final in zip(got["low"], last, strict=True)]
        return got.assign(low=names[got["low"]], high=names[got["high"]])[["low", "high", "height", "size", "label", "round"]]

    kind = pairs.schema["a"].dataType.simpleString()
    one = lambda df: df.withColumn("_bucket", F.lit(0)).groupBy("_bucket")
    return one(pairs).cogroup(one(clusters)).applyInPandas(fold, f"low {kind}, high {kind}, height double, size long, label string, round int")


def _agglomerate(distances: DataFrame, method: str, missing: float, max_rounds: int, fold_pairs: int = FOLD_PAIRS) -> tuple[DataFrame, DataFrame]:
    known = settle(distances.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min(F.col("distance").cast("double")).alias("d")))
    names = known.select(F.explode(F.array("a", "b")).alias("c")).distinct()
    clusters = settle(names.select("c", F.lit(1).cast("long").alias("size"), F.lit(0.0).alias("height"), F.col("c").cast("string").alias("label")))
    pairs = known.where("a <> b")
    done = []
    for n in range(1, max_rounds + 1):
        total = pairs.count()
        if total <= fold_pairs:
            if total:
                met = pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct()
                merged = settle(_rounds_folded(pairs, clusters.join(met, "c", "left_semi"), method, missing, n - 1))
                done.append(merged)
                gone = merged.select(F.explode(F.array("low", "high")).alias("c"))
                ended = merged.where("label is not null").select(F.col("low").alias("c"), "size", "height", "label")
                clusters = settle(clusters.join(gone, "c", "left_anti").unionByName(ended))
            break
        key = F.struct("d", "a", "b")
        nearest = pairs.select(F.explode(F.array("a", "b")).alias("c"), key.alias("k")).groupBy("c").agg(F.min("k").alias("k"))
        mutual = nearest.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n = 2").select(F.col("k.a").alias("low"), F.col("k.b").alias("high"), F.col("k.d").alias("d"))
        part = lambda k: clusters.select(F.col("c").alias(k), *(F.col(x).alias(f"{x}_{k}") for x in ("size", "height", "label")))
        merged = mutual.join(part("low"), "low").join(part("high"), "high")
        branches = F.concat(F.lit("("), _branch("label_low", F.col("d") / 2 - F.col("height_low")), F.lit(","), _branch("label_high", F.col("d") / 2 - F.col("height_high")), F.lit(")"))
        merged = settle(merged.select("low", "high", (F.col("d") / 2).alias("height"), (F.col("size_low") + F.col("size_high")).alias("size"), branches.alias("label"), F.lit(n).alias("round")))
        done.append(merged)
        goes = merged.select(F.col("high").alias("c"), F.col("low").alias("to"))
        for c in ("a", "b"):
            size = clusters.select(F.col("c").alias(c), F.col("size").alias(f"w{c}"))
            pairs = pairs.join(size, c).join(goes.withColumnRenamed("c", c), c, "left").withColumn(c, F.coalesce("to", c)).drop("to")
        pairs = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "d", (F.col("wa") * F.col("wb")).alias("w"))
        gone = merged.select(F.explode(F.array("low", "high")).alias("c"))
        clusters = settle(clusters.join(gone, "c", "left_anti").unionByName(merged.select(F.col("low").alias("c"), "size", "height", "label")))
        pairs = pairs.groupBy("a", "b").agg(F.max("d").alias("most"), F.min("d").alias("least"), F.sum(F.col("d") * F.col("w")).alias("sum"), F.sum("w").alias("w"))
        size = lambda c: clusters.select(F.col("c").alias(c), F.col("size").alias(f"n{c}"))
        pairs = pairs.join(size("a"), "a").join(size("b"), "b").withColumn("whole", F.col("na") * F.col("nb"))
        pairs = settle(pairs.select("a", "b", _joined(method, missing).alias("d")))
    else:
        raise RuntimeError(f"clusters are left to merge after {max_rounds} rounds")
    none = clusters.select(F.col("c").alias("low"), F.col("c").alias("high"), "height", "size", "label", F.lit(0).alias("round")).limit(0)
    return reduce(DataFrame.unionByName, done, none), clusters


def linkage(distances: DataFrame, method: str = "complete", missing: float = 1.0, max_rounds: int = 10_000, fold_pairs: int = FOLD_PAIRS) -> DataFrame:
    """low, high, height, size, round: the merges of hierarchical clustering; a cluster is known by its smallest item.

    distances: a, b, distance; pairs of items that lack a row have the distance `missing`, which should be no less than any, and clusters without
    any row between them stay apart, trees of their own. method: complete, average or single. These linkages are
    reducible: merging two clusters brings none nearer to a third. So all pairs that are each other's nearest merge in one
    round, the same merges that one at a time, nearest first, would give. A round is an aggregation of pairs for the nearest ones and
    one for the new distances; once at most fold_pairs pairs are left, one task goes through the same rounds over them. Ties go to the smaller items (with single linkage, equal distances may give another
    tree of the same heights). Height is half the distance.
    """
    return _agglomerate(distances, method, missing, max_rounds, fold_pairs)[0].drop("label")


def linkage_newick(distances: DataFrame, method: str = "complete", missing: float = 1.0, max_rounds: int = 10_000, fold_pairs: int = FOLD_PAIRS) -> DataFrame:
    """newick: the trees of linkage, one row each, in all one if no two parts lack distances; the smaller side of a merge first."""
    clusters = _agglomerate(distances, method, missing, max_rounds, fold_pairs)[1]
    return clusters.select(F.concat("label", F.lit(";")).alias("newick"))


#: Items of a block of clusters, pairs of blocks that one task goes through, and items of either side and elements of the parts of blocks that are multiplied at once.
BLOCK_ITEMS, BLOCK_PAIRS, PART_ITEMS, PART_ELEMENTS = 2048, 64, (128, 2048), 4096


def _packed(where: DataFrame, blocks: int) -> DataFrame:
    """block, c, n, x: one row a block of whole clusters, packed: cluster and number of elements of each item, by cluster, and the elements of all. where: c, xs."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("c", kind="stable")
        c, n = pdf["c"].to_numpy(dtype="int64"), pdf["xs"].map(len).to_numpy(dtype="int32")
        x = np.concatenate(pdf["xs"].tolist()).astype("int32")
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "c": [c.tobytes()], "n": [n.tobytes()], "x": [x.tobytes()]})

    rows = where.select(F.pmod(F.xxhash64("c"), F.lit(blocks)).cast("int").alias("block"), "c", "xs")
    return rows.groupBy("block").applyInPandas(pack, "block int, c binary, n binary, x binary")


def _unpacked(pdf: pd.DataFrame, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(pdf[f"{k}_{side}"].iloc[0], t) for k, t in (("c", "int64"), ("n", "int32"), ("x", "int32")))


def _shares(one: tuple, two: tuple) -> tuple[np.ndarray, np.ndarray]:
    """For the clusters of two blocks: the least share, in percent, of Jaccard's between items of either, and whether any two of them share an element; parts of blocks are multiplied at a time."""
    starts = [np.flatnonzero(np.diff(c, prepend=-1)) for c, _, _ in (one, two)]
    least, meet = np.full((len(starts[0]), len(starts[1])), np.inf), np.zeros((len(starts[0]), len(starts[1])), bool)
    elements = np.intersect1d(one[2], two[2])

    def parts(side: tuple, start: np.ndarray, most: int):  # noqa: ANN202
        of, ends = np.searchsorted(start, np.arange(len(side[0])), "right") - 1, np.cumsum(side[1])
        for k in range(0, len(of), most):
            n = side[1][k : k + most]
            x = side[2][ends[k] - n[0] : ends[k + len(n) - 1]]
            own = of[k : k + most]
            yield n, x, np.repeat(np.arange(len(n)), n), own[0], np.flatnonzero(np.diff(own, prepend=-1))

    def dense(n: np.ndarray, x: np.ndarray, row: np.ndarray, some: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(some, x), len(some) - 1)
        held, out = some[at] == x, np.zeros((len(n), len(some)), np.float32)
        out[row[held], at[held]] = 1
        return out

    def by(f: np.ufunc, values: np.ndarray, *begins: np.ndarray) -> np.ndarray:
        for axis, begin in enumerate(begins):
            if len(begin) < values.shape[axis]:
                values = f.reduceat(values, begin, axis=axis)
        return values

    for n2, x2, row2, first2, begin2 in parts(two, starts[1], PART_ITEMS[1]):
        only = dense(n2, x2, row2, elements).T if 0 < len(elements) <= PART_ELEMENTS else None
        for n1, x1, row1, first1, begin1 in parts(one, starts[0], PART_ITEMS[0]):
            shared = np.zeros((len(n1), len(n2)), np.float32)
            for k in range(0, len(elements), PART_ELEMENTS):
                some = elements[k : k + PART_ELEMENTS]
                shared += dense(n1, x1, row1, some) @ (dense(n2, x2, row2, some).T if only is None else only)
            share = shared.astype(np.float64)
            whole = np.add.outer(n1, n2) - share
            share *= 100
            share /= whole
            here = slice(first1, first1 + len(begin1)), slice(first2, first2 + len(begin2))
            least[here] = np.minimum(least[here], by(np.minimum, share, begin1, begin2))
            meet[here] |= True if shared.min() > 0 else by(np.maximum, shared, begin1, begin2) > 0
    return least, meet


def _met(rows: DataFrame, columns: DataFrame, every: bool, spark_tasks: int, pairs: int) -> DataFrame:
    """x, y, d: the nearest cluster of each in rows, then the smallest, block by block of columns; every: all with x < y. Complete linkage; clusters that share nothing don't meet."""

    def meet(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        if not len(one) or not len(two):
            return pd.DataFrame({"x": np.zeros(0, "int64"), "y": np.zeros(0, "int64"), "d": np.zeros(0)})
        one, two = _unpacked(one, "i"), _unpacked(two, "j")
        least, met = _shares(one, two)
        xs, ys = np.unique(one[0]), np.unique(two[0])
        d = np.where(met & (xs[:, None] != ys[None, :]), np.round(1 - least / 100, 9), np.inf)
        if every:
            i, j = np.nonzero(np.isfinite(d) & (xs[:, None] < ys[None, :]))
        else:
            j = d.argmin(axis=1)  # the first, so the smallest of the nearest
            i = np.flatnonzero(np.isfinite(d[np.arange(len(xs)), j]))
            j = j[i]
        return pd.DataFrame({"x": xs[i], "y": ys[j], "d": d[i, j]})

    tasks = max(spark_tasks, -(-pairs // BLOCK_PAIRS))

    def dealt(df: DataFrame, own: str, others: DataFrame, other: str):  # noqa: ANN202
        packed = df.select(F.col("block").alias(own), *(F.col(k).alias(f"{k}_{own}") for k in "cnx"))
        return packed.crossJoin(F.broadcast(others.select(F.col("block").alias(other)))).repartition(tasks, "i", "j").groupBy("i", "j")

    return dealt(rows, "i", columns, "j").cogroup(dealt(columns, "j", rows, "i")).applyInPandas(meet, "x long, y long, d double")


def set_linkage(sets: DataFrame, max_rounds: int = 10_000, fold_pairs: int = FOLD_PAIRS) -> DataFrame:
    """low, high, height, size: the merges of complete linkage of items by one less Jaccard's share, to nine digits, of their sets. sets: item, x.

    As linkage gives them over a table of these distances, with 1 for items that share nothing, but there is no such table: all pairs of n items are
    looked at a pair of blocks at a time, and what goes out is each cluster's nearest one in a block. Equal sets merge first, at no height, one after the other. A
    round looks again only for clusters that merged, whose nearest one merged, or whose nearest one shares nothing with some of their items: all others'
    stays, since distances only grow. Once at most fold_pairs pairs of clusters can be left, they are listed and a task goes through the rounds that remain.
    """
    spark, sets = sets.sparkSession, settle(sets.where("item is not null").select("item", "x").distinct())
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = numbered(sets.select("x").distinct(), "x").select(F.col("x").alias("_x"), F.col("k").cast("int").alias("k"))
    held = sets.join(names, F.col("x").eqNullSafe(F.col("_x"))).groupBy("item").agg(F.sort_array(F.collect_list("k")).alias("xs"))
    w = Window.partitionBy("xs")
    twins = held.withColumns({"low": F.min("item").over(w), "size": F.row_number().over(w.orderBy("item")).cast("long"), "n": F.count(F.lit(1)).over(w)})
    twins = settle(twins)
    items = settle(numbered(twins.where("size = 1").select("item", "xs", "n"), "item").select("item", "k", "xs", "n"))
    total = items.count()
    blocks = max(1, -(-total // BLOCK_ITEMS))
    where = items.select(F.col("k").alias("c"), "xs")
    clusters = items.select(F.col("k").alias("c"), F.col("n").alias("size"))
    near, kept, stale, done, live = None, None, None, [], total
    for n in range(1, max_rounds + 1):
        columns = settle(_packed(where, blocks))
        if live * (live - 1) // 2 <= fold_pairs:
            pairs = _met(columns, columns, True, tasks, blocks * blocks).select(F.col("x").alias("a"), F.col("y").alias("b"), "d")
            pairs = settle(pairs)
            met = pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct()
            rest = clusters.join(met, "c", "left_semi").select("c", "size", F.lit(0.0).alias("height"), F.lit("").alias("label"))
            done.append(_rounds_folded(pairs, rest, "complete", 1.0, n - 1).select("low", "high", "height", "size"))
            break
        again, few = columns, blocks
        if near is not None:
            looked = where.join(stale, "c", "left_semi")
            few = max(1, -(-looked.count() // BLOCK_ITEMS))  # all columns meet each block of these
            again = settle(_packed(looked, few))
        nearest = lambda rows: rows.groupBy("x").agg(F.min(F.struct("d", "y")).alias("m")).select("x", "m.y", "m.d")
        found = nearest(_met(again, columns, False, tasks, few * blocks))
        near = settle(found if near is None else kept.unionByName(found))
        back = near.select(F.col("y").alias("x"), F.col("x").alias("y"))
        mutual = near.where("x < y").join(back, ["x", "y"]).select(F.col("x").alias("low"), F.col("y").alias("high"), "d")
        size = lambda c: clusters.select(F.col("c").alias(c), F.col("size").alias(f"n{c}"))
        merged = mutual.join(size("low"), "low").join(size("high"), "high").select("low", "high", (F.col("d") / 2).alias("height"), (F.col("nlow") + F.col("nhigh")).alias("size"))
        merged = settle(merged)
        new = merged.count()
        if not new:
            break
        done.append(merged)
        live -= new
        goes = merged.select(F.col("high").alias("c"), F.col("low").alias("to"))
        where = settle(where.join(goes, "c", "left").select(F.coalesce("to", "c").alias("c"), "xs"))
        gone = merged.select(F.explode(F.array("low", "high")).alias("c"))
        clusters = settle(clusters.join(gone, "c", "left_anti").unionByName(merged.select(F.col("low").alias("c"), "size")))
        moved = near.join(gone.withColumnRenamed("c", "y"), "y", "left_semi").union(near.where("d >= 1").select("y", "x", "d"))
        stale = merged.select(F.col("low").alias("c")).union(moved.select(F.col("x").alias("c")).join(goes, "c", "left_anti")).distinct()
        stale = settle(stale)
        kept = near.join(stale.withColumnRenamed("c", "x"), "x", "left_anti").join(goes.withColumnRenamed("c", "x"), "x", "left_anti")
    else:
        raise RuntimeError(f"clusters are left to merge after {max_rounds} rounds")
    first = twins.where("size > 1").select("low", F.col("item").alias("high"), F.lit(0.0).alias("height"), "size")
    if not done:
        return first
    of = lambda c: items.select(F.col("k").alias(c), F.col("item").alias(f"_{c}"))
    later = reduce(DataFrame.unionByName, done).join(of("low"), "low").join(of("high"), "high")
    return first.unionByName(later.select(F.col("_low").alias("low"), F.col("_high").alias("high"), "height", "size"))


def neighbour_joining(distances: DataFrame) -> DataFrame:
    """newick: the unrooted tree that neighbour joining gives, one row; nothing for no pair.

    distances: a, b, distance of all pairs. Each round sums the rows of the distances, finds the pair with the least d - r(a) - r(b), where r is a
    row's sum over n - 2, and ties by the smaller items, joins it under the smaller one's name and aggregates the distances to it. Rounds follow
    one another, one for each item but three, so this is for hundreds of items; a round is two jobs over the pairs that are left.
    """
    pairs = settle(distances.where("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min(F.col("distance").cast("double")).alias("d")))
    labels = settle(pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct().select("c", F.col("c").cast("string").alias("label")))
    n = labels.count()
    while n > 3:
        rows = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("c"), "d"), F.struct(F.col("b").alias("c"), "d"))).alias("x")).groupBy("x.c").agg((F.sum("x.d") / (n - 2)).alias("r"))
        q = pairs.join(rows.select(F.col("c").alias("a"), F.col("r").alias("ra")), "a").join(rows.select(F.col("c").alias("b"), F.col("r").alias("rb")), "b")
        best = q.agg(F.min(F.struct(F.round(F.col("d") - F.col("ra") - F.col("rb"), 9).alias("q"), "a", "b", "d", "ra", "rb")).alias("m")).first()["m"]
        a, b, d = F.lit(best["a"]), F.lit(best["b"]), best["d"]
        length = d / 2 + (best["ra"] - best["rb"]) / 2
        to = lambda c: F.when(F.col(c) == b, a).otherwise(F.col(c))
        moved = pairs.where(~((F.col("a") == a) & (F.col("b") == b))).select(to("a").alias("a"), to("b").alias("b"), "d")
        moved = moved.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.when(F.count(F.lit(1)) > 1, (F.sum("d") - d) / 2).otherwise(F.max("d")).alias("d"))
        joined = labels.where(F.col("c") == a).select("c", F.col("label").alias("one")).crossJoin(F.broadcast(labels.where(F.col("c") == b).select(F.col("label").alias("two"))))
        label = F.concat(F.lit("("), _branch("one", F.lit(length)), F.lit(","), _branch("two", F.lit(d - length)), F.lit(")"))
        labels = settle(labels.where((F.col("c") != a) & (F.col("c") != b)).unionByName(joined.select("c", label.alias("label"))))
        pairs, n = settle(moved), n - 1
    sums = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("c"), "d"), F.struct(F.col("b").alias("c"), "d"))).alias("x")).groupBy("x.c").agg(F.sum("x.d").alias("own"))
    total = pairs.agg(F.sum("d").alias("s"))
    last = labels.join(sums, "c").crossJoin(F.broadcast(total))  # three rows at most, and one
    length = F.when(F.lit(n == 3), F.col("own") - F.col("s") / 2).otherwise(F.col("s") / 2)
    branches = F.array_sort(F.collect_list(F.struct("c", _branch("label", length).alias("x"))))
    text = F.concat(F.lit("("), F.array_join(F.transform(branches, lambda y: y["x"]), ","), F.lit(");"))
    return last.agg(text.alias("newick"), F.count(F.lit(1)).alias("n")).where("n > 0").select("newick")
