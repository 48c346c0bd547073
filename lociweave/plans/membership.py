"""Queries over cluster membership."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import membership as M
from .registry import query
from .standin import MEMBERS, REGIONS, members, region_members, table

WITH = f"WITH {MEMBERS}"
WITH_R = f"WITH {MEMBERS}, {REGIONS}"
SIZE = "SELECT cluster, count(*) AS n_genomes FROM {} GROUP BY cluster"


@query(
    "q0_core_shared_singleton",
    f"""{WITH_R}, s AS ({SIZE.format("regions")})
SELECT category, count(*) AS clusters, CAST(sum(n_genomes) AS BIGINT) AS loci FROM (
 SELECT 'core' AS category, n_genomes FROM s WHERE n_genomes * 100 >= 5 * 95 UNION ALL SELECT 'shared', n_genomes FROM s WHERE n_genomes > 1
 UNION ALL SELECT 'singleton', n_genomes FROM s WHERE n_genomes = 1 UNION ALL SELECT 'total', n_genomes FROM s) GROUP BY category""",
)
def q0(spark, sf_dir):
    return M.category_totals(M.classify(region_members(spark, sf_dir), 5, 95))


@query("a11_classification", f"{WITH}, s AS ({SIZE.format('members')}) SELECT cluster, n_genomes, n_genomes * 100 >= 25 * 80 AS is_core, n_genomes > 1 AS is_shared, n_genomes = 1 AS is_singleton FROM s")
def a11(spark, sf_dir):
    return M.classify(members(spark, sf_dir), 25, 80)


@query("a12_size_breakdown", f"{WITH}, s AS ({SIZE.format('members')}) SELECT n_genomes, count(*) AS clusters FROM s GROUP BY n_genomes")
def a12(spark, sf_dir):
    return M.size_breakdown(members(spark, sf_dir))


@query("a10_size_histogram", f"{WITH}, s AS ({SIZE.format('members')}) SELECT genome, n_genomes, count(*) AS clusters FROM members JOIN s USING (cluster) GROUP BY genome, n_genomes")
def a10(spark, sf_dir):
    return M.size_histogram(members(spark, sf_dir))


@query("a10_size_thresholds", f"{WITH}, s AS ({SIZE.format('members')}) SELECT genome, count(*) FILTER (n_genomes >= 15) AS n_large, count(*) FILTER (n_genomes <= 3) AS n_small FROM members JOIN s USING (cluster) GROUP BY genome")
def a10t(spark, sf_dir):
    return M.size_thresholds(members(spark, sf_dir), 15, 3)


@query("a43_exclusive_categories", f"{WITH_R}, s AS ({SIZE.format('regions')}) SELECT CASE WHEN n_genomes * 100 >= 5 * 95 THEN 'core' WHEN n_genomes > 1 THEN 'shared' ELSE 'single' END AS category, count(*) AS clusters FROM s GROUP BY 1")
def a43(spark, sf_dir):
    return M.exclusive_categories(region_members(spark, sf_dir), 5, 95)


@query(
    "a09_pairwise_jaccard",
    f"""{WITH}, n AS (SELECT genome, count(*) AS n FROM members GROUP BY genome),
p AS (SELECT a.genome AS g1, b.genome AS g2, count(*) AS shared FROM members a JOIN members b ON a.cluster = b.cluster AND a.genome < b.genome GROUP BY 1, 2)
SELECT g1, g2, shared, round(shared * 100 / (x.n + y.n - shared), 9) AS jaccard, round(shared * 200 / (x.n + y.n), 9) AS sorensen FROM p JOIN n x ON x.genome = g1 JOIN n y ON y.genome = g2""",
)
def a09(spark, sf_dir):
    p = M.pairwise_shared(members(spark, sf_dir))
    return p.withColumns({c: F.round(c, 9) for c in ("jaccard", "sorensen")})


def _nation_groups(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("genome"), F.col("r_name").alias("label"))


_LABELS = f"""{WITH}, groups AS (SELECT n_nationkey AS genome, r_name AS label FROM nation JOIN region ON n_regionkey = r_regionkey),
tot AS (SELECT label, count(*) AS total FROM groups GROUP BY label), lim AS (SELECT * FROM (VALUES (100.0::DOUBLE, 0.0::DOUBLE), (90.0, 10.0), (75.0, 25.0), (50.0, 0.0)) v(t, f)),
cnt AS (SELECT cluster, label, count(DISTINCT genome) AS n FROM members JOIN groups USING (genome) GROUP BY 1, 2),
cut AS (SELECT label, total, t AS tp, total * t / 100 AS t, total * f / 100 AS f FROM tot, lim),
cut2 AS (SELECT label, tp, CASE WHEN t > total - 1 AND t < total THEN greatest(total - 1, 1) ELSE t END AS t, CASE WHEN f > 0 AND f < 1 THEN 1 ELSE f END AS f FROM cut),
cut3 AS (SELECT label, tp, t, CASE WHEN t = f THEN t - 1 ELSE f END AS f FROM cut2),
lab AS (SELECT c.cluster, cut3.tp AS true_percent, CASE WHEN coalesce(n, 0) >= t THEN label WHEN coalesce(n, 0) <= f THEN 'not_' || label ELSE 'amb_' || label END AS l
 FROM (SELECT DISTINCT cluster FROM cnt) c CROSS JOIN cut3 LEFT JOIN cnt USING (cluster, label)),
labels AS (SELECT cluster, true_percent, string_agg(l, ',' ORDER BY l) AS labels FROM lab GROUP BY 1, 2)"""
_LIMITS = [(100, 0), (90, 10), (75, 25), (50, 0)]


@query("a14_group_labels", f"{_LABELS} SELECT * FROM labels")
def a14(spark, sf_dir):
    return M.group_labels(members(spark, sf_dir), _nation_groups(spark, sf_dir), _LIMITS)


@query("a15_label_combinations", f"{_LABELS} SELECT labels, true_percent, count(*) AS clusters FROM labels GROUP BY 1, 2")
def a15(spark, sf_dir):
    return M.label_combinations(M.group_labels(members(spark, sf_dir), _nation_groups(spark, sf_dir), _LIMITS))


@query("a13_role_rollup", f"{WITH} SELECT r_name AS main, n_name AS sub, count(DISTINCT cluster) AS clusters FROM members JOIN nation ON genome = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)")
def a13(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    roles = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("genome"), F.col("r_name").alias("main"), F.col("n_name").alias("sub"))
    return M.role_rollup(members(spark, sf_dir).join(F.broadcast(roles), "genome"), "main", "sub")


@query("a16_paralog_matchtable", f"""{WITH}, g AS (SELECT p_partkey AS cluster, min(p_partkey) OVER (PARTITION BY p_brand, p_size) AS "group" FROM part)
SELECT "group", genome, count(*) AS n FROM members JOIN g USING (cluster) GROUP BY 1, 2""")
def a16(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cluster"), "p_brand", "p_size")
    groups = p.join(p.groupBy("p_brand", "p_size").agg(F.min("cluster").alias("group")), ["p_brand", "p_size"]).select("cluster", "group")
    return M.group_matchtable(members(spark, sf_dir), groups)


@query("a17_island_weights", f"""{WITH}, i AS (SELECT p_partkey AS cluster, p_brand AS fgi FROM part), t AS (SELECT fgi, count(*) AS total FROM i GROUP BY fgi)
SELECT fgi, genome, round(count(*) * 100 / any_value(total), 9) AS weight FROM members JOIN i USING (cluster) JOIN t USING (fgi) GROUP BY fgi, genome""")
def a17(spark, sf_dir):
    islands = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cluster"), F.col("p_brand").alias("fgi"))
    return M.island_weights(members(spark, sf_dir), islands).withColumn("weight", F.round("weight", 9))


@query("a18_islands_by_genome", f"""{WITH} SELECT genome AS key, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS "values" FROM members JOIN part ON cluster = p_partkey GROUP BY genome""")
def a18(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cluster"), "p_brand")
    return M.joined_values(members(spark, sf_dir).join(p, "cluster"), "genome", "p_brand").withColumnRenamed("genome", "key")


@query("a19_annotations_by_island", "SELECT p_brand AS fgi, p_type AS annotation, count(*) AS n FROM part GROUP BY 1, 2")
def a19(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("fgi"), F.col("p_type").alias("annotation")).agg(F.count(F.lit(1)).alias("n"))


@query("a20_match_summary", f"""{WITH}, m AS (SELECT * FROM members WHERE cluster IN (SELECT p_partkey FROM part WHERE p_size <= 10))
SELECT CAST(genome AS VARCHAR) AS genome, count(*) AS n FROM m GROUP BY genome UNION ALL SELECT 'Total', count(*) FROM m""")
def a20(spark, sf_dir):
    chosen = table(spark, sf_dir, "part").where("p_size <= 10").select(F.col("p_partkey").alias("cluster"))
    return M.match_summary(members(spark, sf_dir), chosen)


def _combos():
    import random

    rng = random.Random(123)
    out = []
    for combo in range(60):
        order = rng.sample(range(25), 1 + combo % 25)
        out += [(combo, k, g) for k, g in enumerate(order, 1)]
    return out


@query("a23_rarefaction", f"""{WITH}, combos AS (SELECT * FROM (VALUES {", ".join(map(str, _combos()))}) v(combo, place, genome)),
s AS (SELECT combo, count(*) AS size FROM combos GROUP BY combo),
n AS (SELECT combo, cluster, count(*) AS n, max(place) AS last FROM combos JOIN members USING (genome) GROUP BY 1, 2),
k AS (SELECT n.*, size, greatest(CASE WHEN size < 10 AND floor(size * 95 / 100) < size THEN floor(size * 95 / 100) + 1 ELSE floor(size * 95 / 100) END, 1) AS need FROM n JOIN s USING (combo))
SELECT combo, size, count(*) FILTER (n >= need) AS core, count(*) FILTER (n < need AND n > 1) AS dispensable, count(*) FILTER (n <= 1 AND n < need) AS "unique", count(*) AS pan, count(*) FILTER (n = 1 AND last = size) AS novel FROM k GROUP BY 1, 2""")
def a23(spark, sf_dir):
    combos = spark.createDataFrame(_combos(), "combo int, place int, genome int")
    return M.rarefaction(members(spark, sf_dir), combos, 95)


@query("a45_prevalence_tallies", f"""{WITH}, s AS ({SIZE.format('members')}) SELECT genome, CASE WHEN n_genomes * 100 / 25 >= 75 THEN 'common' WHEN n_genomes * 100 / 25 <= 25 THEN 'rare' ELSE 'middle' END AS bucket, count(*) AS n
FROM members JOIN s USING (cluster) GROUP BY 1, 2""")
def a45(spark, sf_dir):
    return M.prevalence_tallies(members(spark, sf_dir), 25)


@query("g18_single_copy_core", f"{WITH}, s AS ({SIZE.format('members')}) SELECT cluster FROM s WHERE n_genomes >= 12 AND cluster NOT IN (SELECT p_partkey FROM part WHERE p_size % 3 = 0)")
def g18(spark, sf_dir):
    paralogs = table(spark, sf_dir, "part").where("p_size % 3 = 0").select(F.col("p_partkey").alias("cluster"))
    return M.single_copy_core(members(spark, sf_dir), paralogs, 12)


@query("f16_clusters_by_size", f"{WITH}, s AS ({SIZE.format('members')}) SELECT cluster, n_genomes FROM s WHERE n_genomes BETWEEN 2 AND 5")
def f16(spark, sf_dir):
    return M.by_size(members(spark, sf_dir), 2, 5)


@query("w15_cluster_numbering", f"{WITH}, f AS (SELECT cluster, min(genome) AS g FROM members GROUP BY cluster) SELECT cluster, row_number() OVER (ORDER BY g, cluster) AS number FROM f")
def w15(spark, sf_dir):
    return M.numbering(members(spark, sf_dir), ["genome", "cluster"])


@query("k01_matchtable_0_1", f"""{WITH_R} SELECT cluster, {", ".join(f"CAST(max(CASE WHEN genome = {g} THEN 1 ELSE 0 END) AS INTEGER) AS g{g}" for g in range(5))} FROM regions GROUP BY cluster""")
def k01(spark, sf_dir):
    return M.matchtable(region_members(spark, sf_dir), list(range(5)))


@query("a39_joined_values", f"""{WITH} SELECT cluster, string_agg(DISTINCT r_name, '|' ORDER BY r_name) AS "values" FROM members JOIN nation ON genome = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY cluster""")
def a39(spark, sf_dir):
    return M.joined_values(members(spark, sf_dir).join(F.broadcast(_nation_groups(spark, sf_dir)), "genome"), "cluster", "label", "|")


@query("a29_feature_types", "SELECT user_id % 10 AS genome, event_type AS type, count(*) AS n FROM events GROUP BY 1, 2")
def a29(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy((F.col("user_id") % 10).alias("genome"), F.col("event_type").alias("type")).agg(F.count(F.lit(1)).alias("n"))


@query("a30_having_counts", "SELECT l_partkey AS cluster FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_linenumber) = 7")
def a30(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("cluster")).agg(F.countDistinct("l_linenumber").alias("n")).where("n = 7").select("cluster")


@query("a38_genomes_per_cluster", f"{WITH} SELECT cluster, count(DISTINCT genome) AS n, min(genome) AS first_genome, max(genome) AS last_genome FROM members GROUP BY cluster")
def a38(spark, sf_dir):
    return members(spark, sf_dir).groupBy("cluster").agg(F.countDistinct("genome").alias("n"), F.min("genome").alias("first_genome"), F.max("genome").alias("last_genome"))
