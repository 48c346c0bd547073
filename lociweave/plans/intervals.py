"""Queries over intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals as V
from .registry import query
from .standin import INTERVALS, intervals

WITH = f"WITH {INTERVALS}"
#: Two annotations of the same contigs: rows of two kinds, one of each place; strand from the part.
ONE = "SELECT DISTINCT contig, start, stop, name, CAST({} % 2 AS INTEGER) AS orient FROM intervals WHERE kind = '{}'"
AB = f"""{WITH}, a AS ({ONE.format("start", "A")}), b AS ({ONE.format("stop", "R")}), p AS (SELECT a.contig, a.name AS l_name, b.name AS r_name, a.start AS l_start, a.stop AS l_stop, b.start AS r_start, b.stop AS r_stop, a.orient AS l_orient, b.orient AS r_orient,
 round(((least(a.stop, b.stop) - greatest(a.start, b.start) + 1) / (a.stop - a.start + 1) + (least(a.stop, b.stop) - greatest(a.start, b.start) + 1) / (b.stop - b.start + 1)) / 2, 9) AS share FROM a JOIN b ON a.contig = b.contig AND a.start <= b.stop AND b.start <= a.stop),
m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_name ORDER BY share DESC, r_name) AS x, row_number() OVER (PARTITION BY r_name ORDER BY share DESC, l_name) AS y FROM p WHERE share >= 0.5) WHERE x = 1 AND y = 1)"""


def side(spark, sf_dir, kind):
    i = intervals(spark, sf_dir).where(F.col("kind") == kind).select("contig", "start", "stop", "name").distinct()
    return i.withColumn("orient", (F.col("start" if kind == "A" else "stop") % 2).cast("int"))


@query("j06_mutual_overlaps", f"{AB} SELECT l_name, r_name, share FROM m")
def j06(spark, sf_dir):
    return V.mutual_overlaps(side(spark, sf_dir, "A"), side(spark, sf_dir, "R"), 200).select("l_name", "r_name", "share")


@query("j06_overlap_join", f"{AB} SELECT contig, l_name, r_name, share FROM p")
def j06p(spark, sf_dir):
    return V.overlap_join(side(spark, sf_dir, "A"), side(spark, sf_dir, "R"), 200).select("contig", "l_name", "r_name", F.round(V.overlap_share(), 9).alias("share"))


@query(
    "u07_annotation_difference",
    f"""{AB}, k AS (SELECT l_name, r_name, l_orient <> r_orient AS t, CASE WHEN l_start = r_start AND l_stop = r_stop THEN 'SAME' WHEN l_start <> r_start AND l_stop <> r_stop THEN 'BOTH' WHEN l_start <> r_start THEN 'DIFF_5P' ELSE 'DIFF_3P' END AS d FROM m)
SELECT l_name AS old_name, r_name AS new_name, CASE WHEN t AND d = 'SAME' THEN 'INVERT' WHEN t THEN d || '_INVERT' ELSE d END AS difference FROM k
UNION ALL SELECT name, NULL, 'REMOVED' FROM a WHERE name NOT IN (SELECT l_name FROM m) UNION ALL SELECT NULL, name, 'NEW' FROM b WHERE name NOT IN (SELECT r_name FROM m)""",
)
def u07(spark, sf_dir):
    return V.annotation_difference(side(spark, sf_dir, "A"), side(spark, sf_dir, "R"), 200)


UNION = f"""{WITH}, s AS (SELECT contig, start, stop, max(stop) OVER (PARTITION BY contig ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM intervals),
r AS (SELECT *, sum(CASE WHEN before IS NULL OR start > before + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY contig ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS run FROM s), u AS (SELECT contig, run, min(start) AS start, max(stop) AS stop, count(*) AS n FROM r GROUP BY ALL)"""


@query("w08_interval_union", f"{UNION} SELECT contig, start, stop, n FROM u")
def w08(spark, sf_dir):
    return V.union(intervals(spark, sf_dir))


@query("a28_percent_covered", f"{UNION}, n AS (SELECT contig, sum(stop - start + 1) AS n FROM u GROUP BY 1) SELECT c_custkey AS contig, round(coalesce(n, 0) * 100 / 3000, 9) AS percent FROM customer LEFT JOIN n ON c_custkey = contig")
def a28(spark, sf_dir):
    from .standin import table

    lengths = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("contig"), F.lit(3000).alias("length"))
    return V.covered(intervals(spark, sf_dir), lengths).withColumn("percent", F.round("percent", 9))


@query("f14_drop_contained", f"{WITH}, d AS (SELECT contig, start, stop, min(name) AS name FROM intervals GROUP BY ALL) SELECT * FROM d x WHERE NOT EXISTS (SELECT 1 FROM d y WHERE y.contig = x.contig AND y.start <= x.start AND y.stop >= x.stop AND y.name <> x.name)")
def f14(spark, sf_dir):
    d = intervals(spark, sf_dir).groupBy("contig", "start", "stop").agg(F.min("name").alias("name"))
    return V.drop_contained(d)


@query("j09_resolve_conflicts", f"""{WITH}, d AS (SELECT contig, start, stop, min(name) AS name, max(part) AS part FROM intervals GROUP BY ALL)
SELECT contig, start, stop, name, part FROM d x WHERE NOT EXISTS (SELECT 1 FROM d y WHERE y.contig = x.contig AND y.name <> x.name AND least(x.stop, y.stop) - greatest(x.start, y.start) + 1 >= 30 AND (y.part > x.part OR y.part = x.part AND y.name < x.name))""")
def j09(spark, sf_dir):
    d = intervals(spark, sf_dir).groupBy("contig", "start", "stop").agg(F.min("name").alias("name"), F.max("part").alias("part"))
    return V.resolve_conflicts(d, ["part"], 200, 30)


@query("w09_merge_runs", f"""{WITH}, d AS (SELECT contig, start, stop, min(name) AS name, min(kind) AS kind FROM intervals GROUP BY contig, start, stop), c AS (SELECT *, CASE WHEN lag(kind) OVER w IS NOT DISTINCT FROM kind THEN 0 ELSE 1 END AS c FROM d WINDOW w AS (PARTITION BY contig ORDER BY start, stop, name)),
r AS (SELECT *, sum(c) OVER (PARTITION BY contig ORDER BY start, stop, name ROWS UNBOUNDED PRECEDING) AS run FROM c) SELECT contig, kind, min(start) AS start, max(stop) AS stop, count(*) AS n FROM r GROUP BY contig, run, kind""")
def w09(spark, sf_dir):
    d = intervals(spark, sf_dir).groupBy("contig", "start", "stop").agg(F.min("name").alias("name"), F.min("kind").alias("kind"))
    return V.merge_runs(d, "kind")


@query("w09_trim_by_priority", f"""{WITH}, d AS (SELECT contig, start, stop, min(name) AS name, min(kind) AS kind FROM intervals GROUP BY contig, start, stop), e AS (SELECT DISTINCT contig, unnest([start, stop + 1]) AS start FROM d), p AS (SELECT contig, start, lead(start) OVER (PARTITION BY contig ORDER BY start) - 1 AS stop FROM e),
o AS (SELECT p.contig, p.start, p.stop, arg_min(d.name, (kind, d.start, d.name)) AS name, min(kind) AS kind FROM p JOIN d ON d.contig = p.contig AND d.start <= p.start AND d.stop >= p.stop GROUP BY 1, 2, 3), n AS (SELECT *, CASE WHEN lag(stop) OVER w + 1 = start THEN 0 ELSE 1 END AS new FROM o WINDOW w AS (PARTITION BY contig, name ORDER BY start)),
r AS (SELECT *, sum(new) OVER (PARTITION BY contig, name ORDER BY start ROWS UNBOUNDED PRECEDING) AS run FROM n), z AS (SELECT contig, name, kind, min(start) AS start, max(stop) AS stop FROM r GROUP BY contig, name, kind, run) SELECT contig, name, kind, start, stop FROM (SELECT *, row_number() OVER (PARTITION BY contig, name ORDER BY stop - start DESC, start) AS k FROM z) WHERE k = 1""")
def w09t(spark, sf_dir):
    d = intervals(spark, sf_dir).groupBy("contig", "start", "stop").agg(F.min("name").alias("name"), F.min("kind").alias("kind"))
    return V.trim_by_priority(d, "kind", 200)


@query("j10_range_predicate", f"{WITH} SELECT contig, start, stop, name FROM intervals WHERE start BETWEEN 2000 AND 2100 OR stop BETWEEN 2000 AND 2100")
def j10(spark, sf_dir):
    return intervals(spark, sf_dir).where(F.col("start").between(2000, 2100) | F.col("stop").between(2000, 2100)).select("contig", "start", "stop", "name")


@query("x19_proximal", f"{WITH}, d AS (SELECT contig, start, stop, name, lead(start) OVER w AS s2, lead(stop) OVER w AS e2 FROM intervals WINDOW w AS (PARTITION BY contig ORDER BY start, stop, name)) SELECT contig, count(*) FILTER (start <= e2 AND s2 <= stop) AS n_intersecting, count(*) FILTER (start <= e2 + 50 AND s2 <= stop + 50) AS n_proximal FROM d GROUP BY 1")
def x19(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("contig").orderBy("start", "stop", "name")
    d = intervals(spark, sf_dir).withColumns({"s2": F.lead("start").over(w), "e2": F.lead("stop").over(w)})
    c = [F.col(x) for x in ("start", "stop", "s2", "e2")]
    n = lambda x: F.sum(F.when(x, 1).otherwise(0))
    return d.groupBy("contig").agg(n(V.intersects(*c)).alias("n_intersecting"), n(V.proximal(*c, 50)).alias("n_proximal"))


@query("a46_region_envelope", f"{WITH} SELECT contig, min(start) AS first_start, max(stop) AS last_stop, arg_min(name, (start, name)) AS first_name, arg_max(name, (stop, name)) AS last_name FROM intervals GROUP BY contig")
def a46(spark, sf_dir):
    return intervals(spark, sf_dir).groupBy("contig").agg(F.min("start").alias("first_start"), F.max("stop").alias("last_stop"), F.min_by("name", F.struct("start", "name")).alias("first_name"), F.max_by("name", F.struct("stop", "name")).alias("last_name"))
