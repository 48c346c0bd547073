"""Queries over the order of features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import order as O
from .registry import query
from .standin import FEATURES, features, table

WITH = f"WITH {FEATURES}, sz AS (SELECT cluster, count(DISTINCT genome) AS n_genomes FROM features GROUP BY cluster)"
EDGES = f"""{WITH}, q AS (SELECT * FROM features WHERE cluster IN (SELECT cluster FROM sz WHERE n_genomes >= 8)),
nb AS (SELECT *, lead({{'cluster': cluster, 'e': CASE WHEN orient = 1 THEN 5 ELSE 3 END}}) OVER w AS nx, first_value({{'cluster': cluster, 'e': CASE WHEN orient = 1 THEN 5 ELSE 3 END}}) OVER (PARTITION BY contig ORDER BY pos) AS fx, count(*) OVER (PARTITION BY contig) AS n,
 {{'cluster': cluster, 'e': CASE WHEN orient = 1 THEN 3 ELSE 5 END}} AS me FROM q WINDOW w AS (PARTITION BY contig ORDER BY pos)),
pr AS (SELECT genome, me AS a, coalesce(nx, CASE WHEN contig % 2 = 0 AND n > 1 THEN fx END) AS b FROM nb),
edges AS (SELECT least(a, b).cluster AS c1, least(a, b).e AS e1, greatest(a, b).cluster AS c2, greatest(a, b).e AS e2, genome FROM pr WHERE b IS NOT NULL),
wt AS (SELECT c1, e1, c2, e2, count(DISTINCT genome) AS weight FROM edges GROUP BY ALL),
bw AS (SELECT * FROM wt UNION ALL SELECT c2, e2, c1, e1, weight FROM wt WHERE c1 <> c2 OR e1 <> e2),
best AS (SELECT c1, e1, c2, e2, weight FROM (SELECT bw.*, row_number() OVER (PARTITION BY c1, e1 ORDER BY weight DESC, n_genomes DESC, c2, e2) AS r FROM bw JOIN sz ON c2 = cluster) WHERE r = 1)"""


def sizes(f):
    return f.groupBy("cluster").agg(F.countDistinct("genome").alias("n_genomes"))


def edges(spark, sf_dir):
    f = features(spark, sf_dir)
    return O.adjacency(O.qualifying(f, sizes(f), 8), F.col("contig") % 2 == 0, ["pos"])


def best(spark, sf_dir):
    return O.best_edges(O.edge_weights(edges(spark, sf_dir)), sizes(features(spark, sf_dir)))


@query("w01_positions", f"{WITH} SELECT feat, contig, pos FROM features")
def w01(spark, sf_dir):
    return features(spark, sf_dir).select("feat", "contig", "pos")


@query("j17_neighbours", f"{WITH} SELECT feat, lag(cluster) OVER w AS previous, lead(cluster) OVER w AS next FROM features WINDOW w AS (PARTITION BY contig ORDER BY pos)")
def j17(spark, sf_dir):
    return O.neighbours(features(spark, sf_dir), ["contig"], ["pos"], "cluster").select("feat", "previous", "next")


@query("g04_adjacency", f"{EDGES} SELECT c1, e1, c2, e2, weight FROM wt")
def g04(spark, sf_dir):
    return O.edge_weights(edges(spark, sf_dir))


@query("t03_best_edges", f"{EDGES} SELECT * FROM best")
def t03(spark, sf_dir):
    return best(spark, sf_dir)


@query("g05_mutual_edges", f"{EDGES} SELECT a.* FROM best a JOIN best b ON a.c1 = b.c2 AND a.e1 = b.e2 AND a.c2 = b.c1 AND a.e2 = b.e1 WHERE (a.c1, a.e1) <= (a.c2, a.e2)")
def g05(spark, sf_dir):
    return O.mutual_edges(best(spark, sf_dir))


@query("f22_core_edges", f"{EDGES} SELECT * FROM wt WHERE weight * 100 / 10 >= 30")
def f22(spark, sf_dir):
    return O.core_edges(O.edge_weights(edges(spark, sf_dir)), 10, 30)


@query("a35_adjacency_breaks", f"{EDGES} SELECT c1 AS cluster, CAST(sum(n) AS BIGINT) AS breaks FROM (SELECT c1, e1, count(*) - 1 AS n FROM bw GROUP BY 1, 2) GROUP BY 1")
def a35(spark, sf_dir):
    return O.breaks(O.edge_weights(edges(spark, sf_dir)))


@query("g16_edge_vectors", f"{EDGES} SELECT c1, e1, c2, e2, {' || '.join(f'max(CASE WHEN genome = {g} THEN 1 ELSE 0 END)::VARCHAR' for g in range(10))} AS vector FROM edges GROUP BY ALL")
def g16(spark, sf_dir):
    return O.edge_vectors(edges(spark, sf_dir), list(range(10)))


@query(
    "g10_nearest_core",
    f"""{WITH}, c AS (SELECT f.*, CASE WHEN cluster LIKE '%_7' THEN {{'cluster': cluster, 'at': pos}} END AS core FROM features f),
n AS (SELECT feat, pos, last_value(core IGNORE NULLS) OVER (PARTITION BY contig ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b, first_value(core IGNORE NULLS) OVER (PARTITION BY contig ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS a FROM c)
SELECT feat, b.cluster AS core_before, pos - b.at AS steps_before, a.cluster AS core_after, a.at - pos AS steps_after FROM n""",
)
def g10(spark, sf_dir):
    f = features(spark, sf_dir)
    return O.nearest_core(f, F.col("cluster").like("%_7"), ["pos"]).select("feat", "core_before", "steps_before", "core_after", "steps_after")


@query(
    "w14_bigram_probability",
    """WITH p AS (SELECT coalesce(lag(role) OVER w, last_value(role) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS previous, role AS value FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
n AS (SELECT previous, value, count(*) AS n FROM p GROUP BY ALL), t AS (SELECT previous, count(*) AS total FROM p GROUP BY 1) SELECT previous, value, n, round((n + 1) / (total + (SELECT count(DISTINCT role) FROM conversations)), 9) AS probability FROM n JOIN t USING (previous)""",
)
def w14(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return O.bigram_probability(c, ["conv_id"], ["turn"], "role").withColumn("probability", F.round("probability", 9))


@query(
    "a34_neighbour_conservation",
    f"""{WITH}, s AS (SELECT cluster, 'p' AS side, lag(cluster) OVER w AS nbr FROM features WINDOW w AS (PARTITION BY contig ORDER BY pos) UNION ALL SELECT cluster, 'n', lead(cluster) OVER w FROM features WINDOW w AS (PARTITION BY contig ORDER BY pos)),
n AS (SELECT cluster, side, nbr, count(*) AS n FROM s WHERE nbr IS NOT NULL GROUP BY ALL), m AS (SELECT cluster, side, max(n) AS n FROM n GROUP BY ALL) SELECT cluster, CAST(sum(n) AS BIGINT) AS conserved FROM m GROUP BY 1""",
)
def a34(spark, sf_dir):
    return O.neighbour_conservation(features(spark, sf_dir), ["pos"])


_HALF = "SELECT o_custkey AS contig, l_returnflag AS cluster, l_partkey AS \"at\", l_orderkey * 100000 + l_partkey AS name, l_suppkey AS qstart, l_suppkey + CAST(l_quantity AS INTEGER) AS qend FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_returnflag, l_quantity FROM lineitem) JOIN orders ON l_orderkey = o_orderkey"


@query(
    "w13_split_genes",
    f"""WITH h AS ({_HALF}), h1 AS (SELECT contig, cluster, "at", name, qstart, min(qend) AS qend FROM h GROUP BY ALL), h2 AS (SELECT * FROM h1 QUALIFY row_number() OVER (PARTITION BY contig, cluster, "at", name ORDER BY qstart) = 1),
r AS (SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY contig, cluster) AS n, coalesce(lag(name) OVER w, last_value(name) OVER v) AS pn, coalesce(lag(qstart) OVER w, last_value(qstart) OVER v) AS ps, coalesce(lag(qend) OVER w, last_value(qend) OVER v) AS pe FROM h2
 WINDOW w AS (PARTITION BY contig, cluster ORDER BY "at", name), v AS (PARTITION BY contig, cluster ORDER BY "at", name ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT contig, cluster, pn AS first, name AS second FROM r WHERE n > 1 AND (r < n OR n = 2 AND r = 1) AND greatest(least(qend, pe) - greatest(qstart, ps) + 1, 0) <= 0.2::DOUBLE * least(qend - qstart + 1, pe - ps + 1)""",
)
def w13(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity").distinct()
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    h = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("contig"), F.col("l_returnflag").alias("cluster"), F.col("l_partkey").alias("at"), (F.col("l_orderkey") * 100000 + F.col("l_partkey")).alias("name"), F.col("l_suppkey").alias("qstart"), (F.col("l_suppkey") + F.col("l_quantity").cast("int")).alias("qend"))
    h = h.groupBy("contig", "cluster", "at", "name").agg(F.min(F.struct("qstart", "qend")).alias("x")).select("contig", "cluster", "at", "name", "x.qstart", "x.qend")
    return O.split_genes(h)


@query("w10_gap_groups")
def w10(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal", "c_custkey")
    return O.gap_groups(c, "c_nationkey", "c_acctbal", 25.0)


@query(
    "w07_low_coverage",
    """WITH c AS (SELECT user_id AS contig, (event_id % 500) + 1 AS position, CAST(max(value) AS INTEGER) AS coverage, 600 AS length FROM events GROUP BY 1, 2), h AS (SELECT * FROM c WHERE coverage >= 20),
g AS (SELECT contig, coalesce(lag(position) OVER (PARTITION BY contig ORDER BY position), 0) + 1 AS start, position - 1 AS stop FROM h), e AS (SELECT contig, coalesce(max(CASE WHEN coverage >= 20 THEN position END), 0) + 1 AS start, max(length) AS stop FROM c GROUP BY 1)
SELECT * FROM (SELECT * FROM g UNION ALL SELECT * FROM e) WHERE start <= stop""",
)
def w07(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("contig"), ((F.col("event_id") % 500) + 1).alias("position")).agg(F.round(F.max("value")).cast("int").alias("coverage"))
    return O.low_coverage(e.withColumn("length", F.lit(600).cast("long")), 20)
