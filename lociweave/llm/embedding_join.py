"""Operator 3: epsilon grid order join of embeddings.

Unit vectors whose cosine is at least c lie at most eps = sqrt(2 - 2c) apart.

1. Equal vectors of a label become one node with their number and smallest vec_id, found by a 128-bit key.
2. Principal axes of the unit vectors of each dimension come from sums over all of them
   (per-task sums, added by Spark; a matrix reaches the driver).
3. Each vector's coordinates on the LEADING axes fall into cells of side eps. Vectors are
   sorted by label, then cells in lexicographic order, and cut into sequence intervals
   of BLOCK vectors, each stored as one row with the bounds of its coordinates.
4. Intervals of a label are joined recursively: FAN neighbours form an interval of the next level, up to one for the
   whole label. From there down, pairs of intervals whose bounds come within eps are replaced by the pairs of their
   parts; what is provably farther apart is skipped with all its parts. A pair of the lowest level is split
   in the middle in the same way, and small parts are multiplied out in double precision. A pair returns
   link counts by vector and a spanning forest of its links.
5. Counts are added up, and components of the forests' edges give component_id.

No pair that can link is skipped: projection onto orthonormal axes never lengthens a
distance, and SLACK covers rounding. A popular label only has more intervals; popular vectors and
hubs are joined by broadcast of their few keys.

Input cases: null labels or vectors, zero vectors and those with null or non-finite
components link with nothing; vectors of different length don't link; repeated
rows, and rows that share a vec_id, are vectors of their own; rows without vec_id link like others and count, but never
name a component (null where no other row is reachable) and are not kept; empty table: empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, drop_stored, join_counted, stored, table
from .simhash import lowest

LEADING = 12
BLOCK = 1024
LEAF = 128
FAN_BITS = 4  # FAN = 16
SLACK = 1e-9


def can_link() -> Column:
    """Label and vector there, all components finite, some not zero."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    return F.col("label").isNotNull() & F.coalesce(fine & some, F.lit(False))


def able(vectors: DataFrame) -> DataFrame:
    return vectors.where(can_link())


def unit(flat: np.ndarray, size: int) -> np.ndarray:
    x = flat.astype(float).reshape(-1, size)
    x /= np.abs(x).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def axes(distinct: DataFrame) -> dict[int, np.ndarray]:
    """For each length of vectors, its leading principal axes as columns."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            lists = b.column(0)
            length = np.diff(np.asarray(lists.offsets))
            flat, start = np.asarray(lists.values), np.asarray(lists.offsets)
            for d in np.unique(length).tolist():
                at = start[:-1][length == d]
                x = unit(flat[(at[:, None] + np.arange(d)).ravel()], d)
                total[d] = total.get(d, 0) + x.T @ x
        for d, m in total.items():
            for i in range(d):
                yield pa.RecordBatch.from_arrays([pa.array([d] * d), pa.array([i] * d), pa.array(range(d)), pa.array(m[i])], ["d", "i", "j", "v"])

    rows = distinct.select("embedding").mapInArrow(sums, "d long, i long, j long, v double").groupBy("d", "i", "j").agg(F.sum("v").alias("v"))
    out: dict[int, np.ndarray] = {}
    for d, part in rows.toPandas().groupby("d"):
        m = np.zeros((d, d))
        m[part["i"].to_numpy(), part["j"].to_numpy()] = part["v"].to_numpy()
        _, vectors = np.linalg.eigh((m + m.T) / 2)
        out[int(d)] = vectors[:, ::-1][:, :LEADING]
    return out


def apart(lo_a: np.ndarray, hi_a: np.ndarray, lo_b: np.ndarray, hi_b: np.ndarray) -> float:
    """The least distance between points of two boxes."""
    gap = np.maximum(0, np.maximum(lo_a - hi_b, lo_b - hi_a))
    return math.sqrt(float(gap @ gap))


def join_intervals(x: np.ndarray, y: np.ndarray | None, px: np.ndarray, py: np.ndarray, least: float, eps: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of rows of x and y (None: x itself, i < j) with dot product >= least; p: leading coordinates."""
    same = y is None
    y, py = (x, px) if same else (y, py)
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        if same and a >= d:
            continue
        p, q = px[a:b], py[c:d]
        if (a, b) != (c, d) and apart(p.min(0), p.max(0), q.min(0), q.max(0)) > eps:
            continue
        if b - a <= LEAF and d - c <= LEAF:
            i, j = np.nonzero(x[a:b] @ y[c:d].T >= least)
            i, j = i + a, j + c
            if same:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j
            continue
        m, n = (a + b) // 2 if b - a > LEAF else b, (c + d) // 2 if d - c > LEAF else d
        todo += [(s, t, u, v) for s, t in ((a, m), (m, b)) for u, v in ((c, n), (n, d)) if s < t and u < v and not (same and s > u)]


def block_pairs(bounds: DataFrame, eps: float) -> DataFrame:
    """a, b (a <= b): pairs of blocks of one kind whose bounds come within eps. bounds: block (numbered in order), label, d, lo, hi."""
    kind = ["label", "d"]
    first = bounds.groupBy(*kind).agg(F.min("block").alias("first"), F.count(F.lit(1)).alias("n"))
    most = first.agg(F.count(F.lit(1)).alias("kinds"), F.max("n").alias("most"), F.sum("n").alias("n")).first()
    if not most["kinds"]:
        return bounds.select(F.col("block").alias("a"), F.col("block").alias("b"))
    levels = -(-(most["most"] - 1).bit_length() // FAN_BITS)
    base = join_counted(bounds, first, kind, most["n"], "n").withColumn("at", F.col("block") - F.col("first"))

    def parts(level: int, side: str) -> DataFrame:
        reach = [F.array(*(f(F.get(c, F.lit(k))) for k in range(LEADING))).alias(f"{side}_{c}") for c, f in (("lo", F.min), ("hi", F.max))]
        got = base.groupBy(*kind, F.shiftright("at", FAN_BITS * level).alias(f"{side}_at")).agg(*reach, F.min("block").alias(f"{side}_block"))
        return got.withColumn(side, F.shiftright(f"{side}_at", FAN_BITS))

    gaps = F.transform(F.arrays_zip("a_lo", "a_hi", "b_lo", "b_hi"), lambda z: F.greatest(F.lit(0.0), z["a_lo"] - z["b_hi"], z["b_lo"] - z["a_hi"]))
    far = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    pairs = first.select(*kind, F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    for level in range(levels, -1, -1):
        met = pairs.join(parts(level, "a"), [*kind, "a"]).join(parts(level, "b"), [*kind, "b"])
        met = met.where("a_at <= b_at").where(far <= eps * eps)
        pairs = met.select(*kind, F.col("a_at").alias("a"), F.col("b_at").alias("b"))
    return met.select(F.col("a_block").alias("a"), F.col("b_block").alias("b"))


def in_order(blocks: DataFrame) -> DataFrame:
    """The rows with `block`, numbers from 0 without gaps in the order of partitions and of rows in them."""
    placed = blocks.withColumn("_id", F.monotonically_increasing_id())
    placed = stored(placed.withColumn("_part", F.shiftright("_id", 33)).withColumn("_row", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))))
    per = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))  # a row for each partition
    before = per.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))
    return placed.join(F.broadcast(before), "_part").withColumn("block", F.col("_before") + F.col("_row")).drop("_id", "_part", "_row", "_before")


def link(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row."""
    eps = math.sqrt(max(0.0, 2 - 2 * cosine)) + SLACK
    item = "float" if vectors.schema["embedding"].dataType.elementType == T.FloatType() else "double"
    number = {"float": np.float32, "double": np.float64}[item]
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast(f"array<{item}>").alias("embedding"))
    keyed = able(vectors).withColumns({"k1": F.xxhash64("label", "embedding"), "k2": F.xxhash64(F.lit(1), "embedding", "label")})
    distinct = keyed.groupBy("k1", "k2").agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    distinct = stored(distinct.withColumn("rep", F.monotonically_increasing_id()))
    basis = axes(distinct)

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            start = np.asarray(lists.offsets)
            flat, length = np.asarray(lists.values), np.diff(start)
            cells: list = [None] * b.num_rows
            for d in np.unique(length).tolist():
                rows = np.nonzero(length == d)[0]
                p = unit(flat[(start[:-1][rows][:, None] + np.arange(d)).ravel()], d) @ basis[d]
                for r, c in zip(rows.tolist(), np.floor(p / eps).astype(np.int32).tolist(), strict=True):
                    cells[r] = c
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(length.astype(np.int32)), pa.array(cells, pa.list_(pa.int32()))], ["label", "embedding", "rep", "n", "d", "cells"])

    ordered = distinct.select("label", "embedding", "rep", "n").mapInArrow(order, f"label string, embedding array<{item}>, rep long, n long, d int, cells array<int>")
    ordered = ordered.repartitionByRange("label", "d", "cells", "rep").sortWithinPartitions("label", "d", "cells", "rep")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        kind = None

        def interval() -> pa.RecordBatch:
            label, d = kind
            raw = np.concatenate([v for _, _, v in held])
            p = unit(raw, d) @ basis[d]
            pad = [0.0] * (LEADING - p.shape[1])
            rep = np.array([r for r, _, _ in held], np.int64).tobytes()
            n = np.array([m for _, m, _ in held], np.int64).tobytes()
            columns = [[label], [d], [rep], [n], [raw.tobytes()], [[*p.min(0).tolist(), *pad]], [[*p.max(0).tolist(), *pad]]]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], [f for f, _ in fields])

        fields = [("label", pa.string()), ("d", pa.int32()), ("reps", pa.binary()), ("ns", pa.binary()), ("raw", pa.binary()), ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64()))]
        for b in batches:
            labels, reps, ns, ds = (b.column(k).to_pylist() for k in (0, 2, 3, 4))
            lists = b.column(1)
            start, flat = np.asarray(lists.offsets).tolist(), np.asarray(lists.values)
            for r in range(b.num_rows):
                if held and (kind != (labels[r], ds[r]) or len(held) == BLOCK):
                    yield interval()
                kind = (labels[r], ds[r])
                held.append((reps[r], ns[r], flat[start[r] : start[r + 1]]))
        if held:
            yield interval()

    blocks = in_order(ordered.mapInArrow(cut, "label string, d int, reps binary, ns binary, raw binary, lo array<double>, hi array<double>"))
    pairs = stored(block_pairs(blocks.select("block", "label", "d", "lo", "hi"), eps))
    sides = pairs.select("a", "b", F.col("a").alias("block")).union(pairs.where("a <> b").select("a", "b", F.col("b").alias("block")))
    held = sides.join(blocks.select("block", "d", "reps", "ns", "raw"), "block")

    def compare(group: pa.Table) -> pa.Table:
        sides = sorted(zip(*(group[c].to_pylist() for c in ("block", "d", "reps", "ns", "raw")), strict=True), key=lambda r: r[0])
        d = sides[0][1]
        x = [unit(np.frombuffer(s[4], number), d) for s in sides]
        rep = np.concatenate([np.frombuffer(s[2], np.int64) for s in sides])
        n = np.concatenate([np.frombuffer(s[3], np.int64) for s in sides])
        p = [v @ basis[d] for v in x]
        links, label = np.zeros(len(rep), np.int64), np.arange(len(rep))
        alone = len(sides) == 1
        if alone:
            links += n - 1
        for i, j in join_intervals(x[0], None if alone else x[1], p[0], p[-1], cosine, eps):
            j = j if alone else j + len(x[0])
            np.add.at(links, i, n[j])
            np.add.at(links, j, n[i])
            label = lowest(len(rep), np.concatenate([np.arange(len(rep)), i]), np.concatenate([label, j]))
        some = (links > 0) | (label != np.arange(len(rep)))
        return pa.table({"rep": rep[some], "links": links[some], "root": rep[label[some]]})

    found = stored(held.groupBy("a", "b").applyInArrow(compare, "rep long, links long, root long"))
    nodes = stored(components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))))
    nodes = nodes.union(nodes.select("component", "component").distinct()).toDF("rep", "component")
    named = nodes.join(distinct.select("rep", "first_id"), "rep")
    least = named.groupBy("component").agg(F.min("first_id").alias("least"), F.count(F.lit(1)).alias("many"))
    named = join_counted(named.select("rep", "component"), least, ["component"], distinct.count(), "many").select("rep", "least")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    by_rep = distinct.select("k1", "k2", "rep", "first_id", "n").join(counts, "rep", "left").join(named, "rep", "left")
    by_rep = by_rep.select("k1", "k2", "n", F.coalesce("links", F.lit(0)).alias("_links"), F.when(F.col("least").isNull(), F.col("first_id")).otherwise(F.col("least")).alias("_component"))
    drop_stored(blocks)
    ids = stored(keyed.select("vec_id", "k1", "k2"))
    ids = join_counted(ids, by_rep, ["k1", "k2"], ids.count(), "n").select("vec_id", "_links", "_component")
    rest = vectors.where(~can_link()).select("vec_id", F.lit(0).cast("long").alias("_links"), F.col("vec_id").alias("_component"))
    return ids.union(rest).select(
        "vec_id",
        F.col("_links").cast("long").alias("n_links"),
        F.col("_component").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("_component"), F.lit(False)).alias("kept"),
    )


#: The same rows by brute force. Sums of products are rounded far from the limit, so no pair hangs on their order.
OP3_SQL = """WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
g AS (SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND list_sum(list_transform(e, lambda x: x * x)) > 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS w FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98::DOUBLE),
r AS (SELECT u AS node, u AS low FROM l UNION SELECT l.w, r.low FROM r JOIN l ON l.u = r.node WHERE r.low < l.w),
c AS (SELECT node, min(low) AS low FROM r GROUP BY node), n AS (SELECT u, count(*) AS n FROM l GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(least(low, vec_id), vec_id) AS component_id, coalesce(low, vec_id) >= vec_id AS kept FROM v LEFT JOIN n ON n.u = vec_id LEFT JOIN c ON c.node = vec_id"""


def op3_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "embeddings"))
