"""Queries over trees: distances to the root, new roots, support of clades, batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import trees as R
from .registry import query
from .sets import TREE, tree


def rooted(spark, sf_dir):
    return tree(spark, sf_dir).where("node >= 1")


@query("g13_root_distances", f"{TREE} SELECT node, distance FROM up WHERE ancestor = 1")
def g13r(spark, sf_dir):
    return R.root_distances(rooted(spark, sf_dir))


@query(
    "g13_rerooted",
    f"""{TREE}, e AS (SELECT node AS a, parent AS b, length FROM t WHERE parent > 1 AND node <> 37 UNION ALL SELECT 37, 0, 0.25 UNION ALL SELECT parent, 0, length - 0.25 FROM t WHERE node = 37 UNION ALL SELECT 2, 3, sum(length) FROM t WHERE parent = 1), both_ AS (SELECT a, b, length FROM e UNION ALL SELECT b, a, length FROM e),
w(node, parent, length) AS (SELECT 0::BIGINT, NULL::BIGINT, 0.0::DOUBLE UNION ALL SELECT b, a, both_.length FROM w JOIN both_ ON a = w.node WHERE b IS DISTINCT FROM w.parent) SELECT w.node, w.parent, name, w.length FROM w LEFT JOIN t USING (node)""",
)
def g13n(spark, sf_dir):
    return R.reroot(rooted(spark, sf_dir), 37, 0.25, 0)


@query(
    "g13_midpoint",
    f"""{TREE}, one AS (SELECT node FROM up WHERE ancestor = 1 ORDER BY distance DESC, node LIMIT 1), d1 AS (SELECT y.node, min(x.distance + y.distance) AS d FROM up x JOIN up y ON x.ancestor = y.ancestor WHERE x.node = (FROM one) GROUP BY 1), two AS (SELECT node, d FROM d1 ORDER BY d DESC, node LIMIT 1),
d2 AS (SELECT y.node, min(x.distance + y.distance) AS d FROM up x JOIN up y ON x.ancestor = y.ancestor WHERE x.node = (SELECT node FROM two) GROUP BY 1), way AS (SELECT d1.node, d1.d, lag(d1.node) OVER (ORDER BY d1.d) AS before FROM d1 JOIN d2 USING (node) WHERE d1.d + d2.d = (SELECT d FROM two)),
down AS (SELECT node, before, d - (SELECT d FROM two) / 2 AS above FROM way WHERE d >= (SELECT d FROM two) / 2 ORDER BY d LIMIT 1) SELECT CASE WHEN c.parent = before THEN down.node ELSE before END AS node, CASE WHEN c.parent = before THEN above ELSE b.length - above END AS above FROM down JOIN t c ON c.node = down.node JOIN t b ON b.node = before""",
)
def g13m(spark, sf_dir):
    return spark.createDataFrame([R.midpoint(rooted(spark, sf_dir))], "node long, above double")


@query(
    "g13_clade_support",
    """WITH RECURSIVE r AS (SELECT k AS tree, p_partkey AS node, CASE WHEN p_partkey > 3 AND (p_partkey * (k + 1)) % 7 = 0 THEN p_partkey // 4 WHEN p_partkey > 1 THEN p_partkey // 2 END AS parent FROM part, (SELECT unnest(range(5)) AS k)), t AS (SELECT 0 AS tree, p_partkey AS node, CASE WHEN p_partkey > 1 THEN p_partkey // 2 END AS parent FROM part),
every AS (SELECT true AS own, * FROM t UNION ALL SELECT false, * FROM r), up(own, tree, leaf, node) AS (SELECT own, tree, node, parent FROM every e WHERE NOT EXISTS (SELECT 1 FROM every x WHERE x.own = e.own AND x.tree = e.tree AND x.parent = e.node) UNION ALL SELECT up.own, up.tree, leaf, e.parent FROM up JOIN every e ON e.own = up.own AND e.tree = up.tree AND e.node = up.node WHERE e.parent IS NOT NULL),
c AS (SELECT own, tree, node, md5(string_agg(leaf::VARCHAR, ',' ORDER BY leaf)) AS leaves FROM up WHERE node IS NOT NULL GROUP BY 1, 2, 3), f AS (SELECT leaves, count(DISTINCT tree) AS k FROM c WHERE NOT own GROUP BY 1) SELECT node, coalesce(k, 0) * 100 / 5.0::DOUBLE AS support FROM c LEFT JOIN f USING (leaves) WHERE own""",
)
def g13s(spark, sf_dir):
    """Replicates: in each of five, some nodes hang one level higher."""
    t = rooted(spark, sf_dir)
    k = t.select(F.explode(F.sequence(F.lit(0), F.lit(4))).alias("tree"), "*")
    lifted = (F.col("node") > 3) & ((F.col("node") * (F.col("tree") + 1)) % 7 == 0)
    return R.clade_support(t, k.withColumn("parent", F.when(lifted, F.floor(F.col("node") / 4)).otherwise(F.col("parent"))))


@query("g12_batches", f"{TREE}, l AS (SELECT node FROM t WHERE node NOT IN (SELECT parent FROM t WHERE parent IS NOT NULL)), o AS (SELECT node, ancestor, steps, count(*) OVER (PARTITION BY ancestor) AS n FROM up JOIN l USING (node)) SELECT node AS leaf, arg_max(ancestor, steps) AS batch FROM o WHERE n <= 40 GROUP BY 1")
def g12(spark, sf_dir):
    return R.batches(rooted(spark, sf_dir), 40)
