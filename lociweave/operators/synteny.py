"""Neighbourhood scores of related features, and k-way overlap tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .intervals import measured, overlap_join


def synteny_scores(relations: DataFrame, places: DataFrame, w: int) -> DataFrame:
    """qid, sid, score, winners: how well the neighbourhoods of two related features agree.

    relations: qid, sid, best, bibest (0 or 1); places: id, contig, pos, orient. A related pair at offsets i, j within w counts
    (1 + 2 best + 5 best bibest + relative orientation agrees + same side + (w + 1 - ||i| - |j||)) 3^(w + 1 - max(|i|, |j|)).
    For each i the best j wins, then the smaller |j|, then j; a neighbour that several i choose counts once, with its best
    value. winners: the i whose winner is bibest. Offsets are exploded on one side only: 2 w + 1 rows a relation.
    """
    side = lambda p, k: places.select(F.col("id").alias(k), *(F.col(c).alias(p + c) for c in ("contig", "pos", "orient")))
    r = relations.join(side("q_", "qid"), "qid").join(side("s_", "sid"), "sid")
    at = r.select("qid", "sid", "q_contig", "s_contig", F.col("s_pos").alias("p0"), F.col("q_orient").alias("qo0"), F.col("s_orient").alias("so0"), F.explode(F.sequence(F.lit(-w), F.lit(w))).alias("i"), "q_pos")
    at = at.withColumn("q_pos", F.col("q_pos") + F.col("i")).where("i <> 0")
    near = r.select("q_contig", "s_contig", "q_pos", "s_pos", F.col("q_orient").alias("qo"), F.col("s_orient").alias("so"), "best", "bibest", F.col("sid").alias("nbr"))
    j = at.join(near, ["q_contig", "s_contig", "q_pos"]).withColumn("j", F.col("s_pos") - F.col("p0")).where(f"j between -{w} and {w} and j <> 0")
    same = F.col("qo0") * F.col("so0")
    agrees = (F.col("qo") * F.col("so") == same).cast("int")
    own_side = (F.signum("i") * F.col("qo0") == F.signum("j") * F.col("so0")).cast("int")
    v = 1 + 2 * F.col("best") + 5 * F.col("best") * F.col("bibest") + agrees + own_side + (w + 1 - F.abs(F.abs("i") - F.abs("j")))
    v = v * F.pow(F.lit(3), w + 1 - F.greatest(F.abs("i"), F.abs("j")))
    j = j.withColumn("v", v.cast("long"))
    first = Window.partitionBy("qid", "sid", "i").orderBy(F.col("v").desc(), F.abs("j"), "j")
    won = j.withColumn("_r", F.row_number().over(first)).where("_r = 1")
    by = won.groupBy("qid", "sid", "nbr").agg(F.max("v").alias("v"), F.sum("bibest").alias("b"))
    return by.groupBy("qid", "sid").agg(F.sum("v").alias("score"), F.sum("b").alias("winners"))


def anchors(scores: DataFrame, w: int = 1) -> DataFrame:
    """Pairs with more bibest winners than the window has places on one side: 2 w with the pair itself."""
    return scores.where(F.col("winners") >= 2 * w)


def overlap_table(intervals: DataFrame, species: list, width: int, least: float = 0.5) -> DataFrame:
    """name and, for each other species, the name of its interval that overlaps best and is not used yet.

    Intervals of the first species are served in order of place; an interval is used once. intervals: contig, start, stop, name, species.
    Candidates come from the binned overlap join; the order-dependent choice is a fold over the sorted candidates of each contig. A window
    cuts contigs at gaps that no candidate bridges, and only the names used since the last gap are held.
    """
    intervals, width = measured(intervals, width)
    one, rest = intervals.where(F.col("species") == species[0]), intervals.where(F.col("species") != species[0])
    share = F.expr("(least(l_stop, r_stop) - greatest(l_start, r_start) + 1) / greatest(l_stop - l_start + 1, r_stop - r_start + 1)")
    c = overlap_join(one.drop("species"), rest, width).withColumn("share", F.round(share, 9)).where(F.col("share") >= least)
    w = Window.partitionBy("contig").orderBy("_from", "_to").rowsBetween(Window.unboundedPreceding, -1)
    c = c.withColumns({"_from": F.least("l_start", "r_start"), "_to": F.greatest("l_stop", "r_stop")})
    c = c.withColumn("_new", F.coalesce((F.col("_from") > F.max("_to").over(w)).cast("int"), F.lit(1)))
    c = c.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    c = c.sortWithinPartitions("contig", "_run", "l_start", "l_stop", "l_name", F.col("share").desc(), "r_name")  # contigs lie whole in a partition, as the window asks
    others = [str(s) for s in species[1:]]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = name = None
        used: set = set()
        row: dict = {}
        for b in batches:
            names, taken = [], []
            for contig, r, served, kind, other in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                if (contig, r, served) != (*(run or (None, None)), name):
                    if name is not None:
                        names.append(name)
                        taken.append(row)
                    if (contig, r) != run:
                        run, used = (contig, r), set()
                    name, row = served, {}
                if kind not in row and other not in used:
                    row[kind] = other
                    used.add(other)
            yield table(names, taken)
        if name is not None:
            yield table([name], [row])

    def table(names: list, taken: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), *(pa.array([t.get(s) for t in taken], pa.int64()) for s in others)], ["name", *others])

    return c.select("contig", "_run", "l_name", F.col("r_species").cast("string"), "r_name").mapInArrow(choose, "name long, " + ", ".join(f"`{s}` long" for s in others))


def smoothed_plateaus(rows: DataFrame, tolerance: float = 0.1) -> DataFrame:
    """contig, pos, value, level: along a contig a plateau goes on while a value is within the tolerance of its running mean; level is its largest value.

    The mean carries over rows, so it is a fold over the sorted rows of each contig.
    """

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos", ignore_index=True)
        values = pdf["value"].to_numpy(float)
        group = np.zeros(len(values), np.int64)
        total = count = 0.0
        k = -1
        for n, v in enumerate(values.tolist()):
            if not count or abs(v - total / count) > tolerance * total / count:
                k, total, count = k + 1, 0.0, 0.0
            group[n] = k
            total, count = total + v, count + 1
        pdf["level"] = pdf.groupby(group)["value"].transform("max")
        return pdf[["contig", "pos", "value", "level"]]

    return rows.groupBy("contig").applyInPandas(fold, "contig long, pos long, value double, level double")


def align_ends_free(query: str, subject: str, match: float = 3, mismatch: float = -3, opening: float = -4, extension: float = -1) -> tuple[float, int, int, int]:
    """(score, beg, end, matches) of the whole query within the subject, whose ends are free; 1-based places, affine gaps.

    Row by row over the query; gaps in the query, along a row, by a running maximum. Ties prefer the diagonal, then a gap in the subject.
    """
    s = np.frombuffer(subject.encode("utf-32-le"), np.uint32)
    n = len(s)
    at = np.arange(n + 1)
    low = -1e18
    h, begin, same = np.zeros(n + 1), at.copy(), np.zeros(n + 1, np.int64)
    f, f_begin, f_same = np.full(n + 1, low), at.copy(), np.zeros(n + 1, np.int64)
    for c in np.frombuffer(query.encode("utf-32-le"), np.uint32):
        opened, longer = h + opening + extension, f + extension
        keep = longer > opened
        f, f_begin, f_same = np.where(keep, longer, opened), np.where(keep, f_begin, begin), np.where(keep, f_same, same)
        equal = s == c
        new, nb, ns = f.copy(), f_begin.copy(), f_same.copy()
        diagonal = h[:-1] + np.where(equal, match, mismatch)
        better = diagonal >= new[1:]
        new[1:], nb[1:], ns[1:] = np.where(better, diagonal, new[1:]), np.where(better, begin[:-1], nb[1:]), np.where(better, same[:-1] + equal, ns[1:])
        lifted = new - extension * at
        best = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == best, at, 0))
        before = np.r_[0, source[:-1]]
        gap = np.r_[low, best[:-1]] + opening + extension * at
        use = gap > new
        h, begin, same = np.where(use, gap, new), np.where(use, nb[before], nb), np.where(use, ns[before], ns)
    k = int(h.argmax())
    return float(h[k]), int(begin[k]) + 1, k, int(same[k])


def alignments(pairs: DataFrame) -> DataFrame:
    """id, score, beg, end, matches of pairs (id, query, subject), in Arrow batches."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = [(i, *align_ends_free(q, s)) for i, q, s in zip(pdf["id"], pdf["query"], pdf["subject"], strict=True)]
            yield pd.DataFrame(rows, columns=["id", "score", "beg", "end", "matches"])

    return pairs.select("id", "query", "subject").mapInPandas(run, "id long, score double, beg long, end long, matches long")
