"""Queries over sets, methods and trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sets as U
from ..operators import trees as R
from .registry import query
from .standin import table

SETS = """WITH s AS (SELECT DISTINCT n_regionkey AS "set", l_partkey AS x FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def named(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    li = t("lineitem").select("l_orderkey", "l_partkey")
    c = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_regionkey")
    o = t("orders").select("o_orderkey", "o_custkey").join(c, F.col("o_custkey") == F.col("c_custkey"))
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("n_regionkey").alias("set"), F.col("l_partkey").alias("x")).distinct()


@query("u01_union", f"{SETS} SELECT DISTINCT x FROM s")
def u01(spark, sf_dir):
    return U.union_of(named(spark, sf_dir))


@query("u02_intersection", f"{SETS} SELECT x FROM s GROUP BY x HAVING count(*) = 5")
def u02(spark, sf_dir):
    return U.intersection_of(named(spark, sf_dir), 5)


@query("u03_pairwise_intersections", f'{SETS} SELECT a."set" AS s1, b."set" AS s2, count(*) AS n FROM s a JOIN s b ON a.x = b.x AND a."set" < b."set" GROUP BY 1, 2')
def u03(spark, sf_dir):
    return U.pairwise_intersections(named(spark, sf_dir))


@query("u04_uniques", f'{SETS} SELECT "set", x FROM s WHERE x NOT IN (SELECT x FROM s GROUP BY x HAVING count(*) = 5)')
def u04(spark, sf_dir):
    return U.uniques(named(spark, sf_dir), 5)


@query("u05_differences", f"""{SETS} SELECT 'left' AS side, x FROM (SELECT x FROM s WHERE "set" = 0 EXCEPT SELECT x FROM s WHERE "set" = 1) UNION ALL SELECT 'right', x FROM (SELECT x FROM s WHERE "set" = 1 EXCEPT SELECT x FROM s WHERE "set" = 0)""")
def u05(spark, sf_dir):
    s = named(spark, sf_dir)
    return U.differences(s.where("set = 0").select("x"), s.where("set = 1").select("x"))


@query("u06_subset_pairs", """WITH s AS (SELECT DISTINCT l_suppkey AS "set", l_returnflag || l_linestatus || (l_linenumber % 3) AS x FROM lineitem), n AS (SELECT "set", count(*) AS n FROM s GROUP BY 1), p AS (SELECT a."set" AS i, b."set" AS o, count(*) AS n FROM s a JOIN s b ON a.x = b.x AND a."set" <> b."set" GROUP BY 1, 2) SELECT i AS "inner", o AS "outer" FROM p JOIN n ON n."set" = i AND n.n = p.n""")
def u06(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return U.subset_pairs(li.select(F.col("l_suppkey").alias("set"), F.concat("l_returnflag", "l_linestatus", (F.col("l_linenumber") % 3).cast("string")).alias("x")).distinct())


@query("u08_first_by_key", "SELECT DISTINCT ON (l_suppkey, l_returnflag) l_suppkey, l_returnflag, l_partkey, l_orderkey FROM lineitem ORDER BY l_suppkey, l_returnflag, l_partkey, l_orderkey")
def u08(spark, sf_dir):
    return U.first_by(table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_partkey", "l_orderkey"), ["l_suppkey", "l_returnflag"], ["l_partkey", "l_orderkey"])


def methods(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    one = lambda m, c: p.select(F.lit(m).alias("method"), F.col("p_partkey").alias("gene"), c.cast("string").alias("cluster"))
    return one("a", F.col("p_size")).union(one("b", F.col("p_brand"))).union(one("c", F.col("p_partkey") % 4))


METHODS = "WITH m AS (SELECT 'a' AS method, p_partkey AS gene, CAST(p_size AS VARCHAR) AS cluster FROM part UNION ALL SELECT 'b', p_partkey, p_brand FROM part UNION ALL SELECT 'c', p_partkey, CAST(p_partkey % 4 AS VARCHAR) FROM part)"


@query("u10_method_consensus", f"{METHODS}, s AS (SELECT gene, string_agg(method || ':' || cluster, ',' ORDER BY method || ':' || cluster) AS sig FROM m GROUP BY 1), k AS (SELECT sig, min(gene) AS key FROM s GROUP BY 1 HAVING count(*) > 1) SELECT gene, key FROM s JOIN k USING (sig)")
def u10(spark, sf_dir):
    return U.consensus(methods(spark, sf_dir), 3)


@query("a31_method_similarity", f"{METHODS}, a AS (SELECT gene, cluster, count(*) OVER (PARTITION BY cluster) AS n FROM m WHERE method = 'a'), b AS (SELECT gene, cluster AS other, count(*) OVER (PARTITION BY cluster) AS m FROM m WHERE method = 'b'), j AS (SELECT *, count(*) OVER (PARTITION BY cluster, other) AS shared FROM a JOIN b USING (gene)) SELECT round(avg(shared / (n + m - shared)), 9) AS similarity FROM j")
def a31(spark, sf_dir):
    m = methods(spark, sf_dir)
    pick = lambda x: m.where(F.col("method") == x).select("gene", "cluster")
    return U.method_similarity(pick("a"), pick("b")).withColumn("similarity", F.round("similarity", 9))


def tree(spark, sf_dir):
    """A tree over parts: parent = part halved; length from the size."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("node"), F.when(F.col("p_partkey") > 1, F.floor(F.col("p_partkey") / 2)).alias("parent"), F.col("p_partkey").cast("string").alias("name"), F.col("p_size").cast("double").alias("length"))


TREE = """WITH RECURSIVE t AS (SELECT p_partkey AS node, CASE WHEN p_partkey > 1 THEN p_partkey // 2 END AS parent, CAST(p_partkey AS VARCHAR) AS name, p_size::DOUBLE AS length FROM part WHERE p_partkey >= 1),
up(node, ancestor, steps, distance) AS (SELECT node, node, 0::BIGINT, 0.0::DOUBLE FROM t UNION ALL SELECT up.node, t.parent, steps + 1, distance + t.length FROM up JOIN t ON t.node = up.ancestor WHERE t.parent IS NOT NULL)"""


@query("g13_ancestors", f"{TREE} SELECT node, ancestor, steps, distance FROM up")
def g13(spark, sf_dir):
    return R.ancestors(tree(spark, sf_dir).where("node >= 1"))


@query("g13_node_distances", f"{TREE}, p AS (SELECT node AS a, node + 7 AS b FROM t WHERE node + 7 <= (SELECT max(node) FROM t)), j AS (SELECT a, b, x.ancestor, x.steps, x.distance + y.distance AS d, row_number() OVER (PARTITION BY a, b ORDER BY x.steps) AS r FROM p JOIN up x ON x.node = a JOIN up y ON y.node = b AND y.ancestor = x.ancestor) SELECT a, b, ancestor AS lca, round(d, 9) AS distance FROM j WHERE r = 1")
def g13d(spark, sf_dir):
    t = tree(spark, sf_dir).where("node >= 1")
    pairs = t.select(F.col("node").alias("a"), (F.col("node") + 7).alias("b")).join(t.select(F.col("node").alias("b")), "b", "left_semi").select("a", "b")
    return R.leaf_distances(t, pairs)


@query("g13_clade_sizes", f"{TREE}, l AS (SELECT node, name FROM t WHERE node NOT IN (SELECT parent FROM t WHERE parent IS NOT NULL)) SELECT ancestor AS node, count(*) AS n, min(name) AS first, max(name) AS last FROM up JOIN l USING (node) WHERE steps > 0 GROUP BY 1")
def g13c(spark, sf_dir):
    c = R.clades(tree(spark, sf_dir).where("node >= 1"))
    return c.select("node", F.size("leaves").cast("long").alias("n"), F.array_min("leaves").alias("first"), F.array_max("leaves").alias("last"))


@query("j23_ancestor_of_class", f"{TREE}, c AS (SELECT p_partkey AS ancestor FROM part WHERE p_size % 5 = 0), j AS (SELECT node, ancestor, row_number() OVER (PARTITION BY node ORDER BY steps) AS r FROM up JOIN c USING (ancestor)) SELECT node, ancestor AS found FROM j WHERE r = 1")
def j23(spark, sf_dir):
    t = tree(spark, sf_dir).where("node >= 1")
    return R.ancestor_of_class(t, table(spark, sf_dir, "part").select(F.col("p_partkey").alias("node"), F.when(F.col("p_size") % 5 == 0, "family").otherwise("other").alias("class")), "family")


@query("a36_gains_and_losses", """WITH s AS (SELECT p_partkey AS node, unnest(range(4)) AS k FROM part), p AS (SELECT node, k, (node * (k + 3)) % 5 < 2 AS present FROM s), j AS (SELECT a.node, a.present, b.present AS before FROM p a JOIN p b ON b.node = a.node // 2 AND a.k = b.k WHERE a.node > 1)
SELECT node, CAST(sum(CASE WHEN present AND NOT before THEN 1 ELSE 0 END) AS BIGINT) AS gains, CAST(sum(CASE WHEN NOT present AND before THEN 1 ELSE 0 END) AS BIGINT) AS losses FROM j GROUP BY 1""")
def a36(spark, sf_dir):
    t = tree(spark, sf_dir)
    s = t.select("node", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("character")).withColumn("present", (F.col("node") * (F.col("character") + 3)) % 5 < 2)
    return R.gains_and_losses(t, s)
