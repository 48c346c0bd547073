"""Queries over annotations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import annotation as A
from ..operators import order as O
from .registry import query
from .standin import HITS, hits, table

WITH = f"WITH {HITS}"
TERMS = "mapping AS (SELECT DISTINCT p_partkey AS sid, p_type AS term FROM part)"


def terms(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("sid"), F.col("p_type").alias("term")).distinct()


@query("j12_hits_to_terms", f"{WITH}, {TERMS} SELECT qid, h.sid, bits, term FROM hits h LEFT JOIN mapping m ON h.sid = m.sid WHERE evalue <= 5e-6::DOUBLE")
def j12(spark, sf_dir):
    return A.map_hits(hits(spark, sf_dir), terms(spark, sf_dir), 5e-6).select("qid", "sid", "bits", "term")


@query("j13_first_match_terms", f"{WITH}, {TERMS}, r AS (SELECT qid, sid, row_number() OVER (PARTITION BY qid ORDER BY bits DESC, sid) AS r FROM hits WHERE sid IN (SELECT sid FROM mapping)) SELECT DISTINCT qid, r.sid, term FROM r JOIN mapping m ON m.sid = r.sid WHERE r = 1")
def j13(spark, sf_dir):
    return A.first_match_terms(hits(spark, sf_dir), terms(spark, sf_dir))


@query("j14_term_aspects", "SELECT p_partkey AS id, t.term, n_regionkey AS aspect FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS term FROM part) t JOIN (SELECT lower(r_name) AS term, r_regionkey AS n_regionkey FROM region UNION ALL SELECT DISTINCT string_split(p_name, ' ')[1], 9 FROM part) a ON a.term = t.term")
def j14(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    r = table(spark, sf_dir, "region").select(F.lower("r_name").alias("term"), F.col("r_regionkey").alias("aspect"))
    first = p.select(F.get(F.split("p_name", " "), F.lit(0)).alias("term")).distinct().withColumn("aspect", F.lit(9))
    t = p.select(F.col("p_partkey").alias("id"), F.split("p_name", " ").alias("terms"))
    return A.aspects(t, r.union(first)).select("id", "term", "aspect")


@query("x27_slim_category", "SELECT l_orderkey AS id, arg_max(c, place) AS category FROM (SELECT l_orderkey, l_partkey * 1000 + l_suppkey AS place, max(CASE WHEN l_returnflag <> 'N' THEN l_returnflag || l_linestatus END) AS c FROM lineitem GROUP BY 1, 2) WHERE c IS NOT NULL GROUP BY 1")
def x27(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), (F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("place"), F.when(F.col("l_returnflag") != "N", F.concat("l_returnflag", "l_linestatus")).alias("c"))
    return A.slim_category(li.groupBy("id", "place").agg(F.max("c").alias("category")))


CLASSES = f"{WITH}, c AS (SELECT qid, sid, bits, CASE WHEN pid >= 100 AND len = 50 THEN 'Perfect' WHEN bits >= 40000 THEN 'Strict' ELSE 'Loose' END AS class FROM hits)"


def classes(spark, sf_dir):
    h = hits(spark, sf_dir)
    return h.select("qid", "sid", "bits", A.hit_class(F.col("pid"), F.col("len"), F.lit(50), F.col("bits"), F.lit(40000)).alias("class"))


@query("x23_hit_classes", f"{CLASSES}, r AS (SELECT *, CASE class WHEN 'Perfect' THEN 1 WHEN 'Strict' THEN 2 ELSE 3 END AS k FROM c), b AS (SELECT *, min(k) OVER (PARTITION BY qid) AS m FROM r) SELECT qid, sid, bits, class FROM b WHERE k = m")
def x23(spark, sf_dir):
    return A.best_class_only(classes(spark, sf_dir))


@query("t07_improving_hit")
def t07(spark, sf_dir):
    return A.improving_hit(hits(spark, sf_dir))


@query(
    "x28_flank_calls",
    """WITH f AS (SELECT event_id AS query, CASE WHEN event_id % 7 = 0 THEN 90 + event_id % 10 END AS full_pid, CASE WHEN event_id % 5 <> 0 THEN event_id % 100 END AS q5, CASE WHEN event_id % 11 <> 0 THEN event_id % 100 + event_id % 23 END AS q3, user_id % 50 AS s5, user_id % 50 + event_id % 13 - 3 AS s3 FROM events)
SELECT query, CASE WHEN full_pid IS NOT NULL THEN CASE WHEN full_pid < 98 THEN 'MUTATION' END WHEN q5 IS NULL AND q3 IS NULL THEN NULL WHEN q5 IS NULL OR q3 IS NULL THEN 'PARTIAL' WHEN q3 - q5 - 1 > 10 THEN 'INSERTION' WHEN s3 - s5 - 1 < 0 THEN 'TANDEM_DUPLICATION' WHEN s3 - s5 - 1 > 0 THEN 'DELETION' END AS call FROM f""",
)
def x28(spark, sf_dir):
    e, u = F.col("event_id"), F.col("user_id")
    f = table(spark, sf_dir, "events").select(e.alias("query"), F.when(e % 7 == 0, e % 10 + 90).alias("full_pid"), F.when(e % 5 != 0, e % 100).alias("q5"), F.when(e % 11 != 0, e % 100 + e % 23).alias("q3"), (u % 50).alias("s5"), (u % 50 + e % 13 - 3).alias("s3"))
    return A.flank_calls(f)


STATS = """WITH m AS (SELECT l_partkey AS cluster, CAST(l_quantity AS INTEGER) * 10 + l_suppkey % 10 AS length, l_suppkey AS genome FROM lineitem), g AS (SELECT cluster, count(*) AS n, min(length) AS least, max(length) AS most, avg(length) AS mean, coalesce(stddev_samp(length), 0) AS sd, list_sort(list(length)) AS v FROM m GROUP BY 1),
s AS (SELECT *, CASE WHEN n % 2 = 1 THEN v[n // 2 + 1]::DOUBLE ELSE (v[greatest(n // 2, 1)] + v[n // 2 + 1]) / 2 END AS median, greatest((n + 1) // 4, 1) AS k FROM g), q AS (SELECT *, CASE WHEN n < 4 THEN median ELSE v[k]::DOUBLE END AS q1, CASE WHEN n < 4 THEN median ELSE v[n - k + 1]::DOUBLE END AS q3 FROM s)"""


def lengths(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("cluster"), (F.col("l_quantity").cast("int") * 10 + F.col("l_suppkey") % 10).alias("length"), F.col("l_suppkey").alias("genome"))


@query("a42_length_stats", f"{STATS} SELECT cluster, n, least, most, round(mean, 6) AS mean, round(sd, 6) AS sd, median, q1, q3 FROM q")
def a42(spark, sf_dir):
    return A.length_stats(lengths(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("mean", "sd")})


@query("a04_length_spread", "SELECT l_partkey AS cluster, min(l_quantity) AS least, max(l_quantity) AS most, round(avg(l_quantity), 6) AS mean, round(coalesce(stddev_samp(l_quantity), 0), 6) AS sd FROM lineitem GROUP BY 1")
def a04(spark, sf_dir):
    q = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("cluster")).agg(F.min(q).alias("least"), F.max(q).alias("most"), F.round(F.avg(q), 6).alias("mean"), F.round(F.coalesce(F.stddev_samp(q), F.lit(0.0)), 6).alias("sd"))


@query("x32_allele_categories", f"{STATS}, c AS (SELECT cluster, length, count(*) AS copies FROM m GROUP BY 1, 2), a AS (SELECT CASE WHEN genome % 17 = 0 THEN 'gapped' WHEN length < q1 - 0.1::DOUBLE * median THEN 'very_short' WHEN length < q1 - 0.02::DOUBLE * median THEN 'short' WHEN length > q3 + 0.1::DOUBLE * median THEN 'very_long' WHEN length > q3 + 0.02::DOUBLE * median THEN 'long' WHEN copies = 1 THEN 'unique' ELSE 'identical' END AS category FROM m JOIN q USING (cluster) JOIN c USING (cluster, length)) SELECT category, count(*) AS n FROM a GROUP BY 1")
def x32(spark, sf_dir):
    m = lengths(spark, sf_dir)
    copies = m.groupBy("cluster", "length").agg(F.count(F.lit(1)).alias("copies"))
    j = m.join(A.length_stats(m), "cluster").join(copies, ["cluster", "length"])
    c = A.allele_category(F.col("length"), F.col("copies"), F.col("genome") % 17 == 0, {k: F.col(k) for k in ("q1", "q3", "median")})
    return j.groupBy(c.alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query("x34_best_references", """WITH d AS (SELECT c_nationkey AS genome, c_mktsegment AS reference, max(90 + c_acctbal / 1000) AS ani FROM customer GROUP BY 1, 2), r AS (SELECT *, row_number() OVER w AS r, lead(ani) OVER w AS second_ani FROM d WINDOW w AS (PARTITION BY genome ORDER BY ani DESC, reference))
SELECT genome, reference AS best, round(ani, 6) AS best_ani, round(second_ani, 6) AS second_ani, CASE WHEN ani >= 97 AND ani - coalesce(second_ani, 0) >= 0.5::DOUBLE THEN 'species' WHEN ani >= 97 THEN 'ambiguous' WHEN ani >= 94 THEN 'genus' ELSE 'none' END AS level FROM r WHERE r = 1""")
def x34(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("genome"), F.col("c_mktsegment").alias("reference"), (F.lit(90) + F.col("c_acctbal") / 1000).alias("ani"))
    return A.best_references(c).withColumns({k: F.round(k, 6) for k in ("best_ani", "second_ani")})


@query("a47_event_tallies", "SELECT user_id % 10 AS sample, event_type AS class, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2")
def a47(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy((F.col("user_id") % 10).alias("sample"), F.col("event_type").alias("class")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"))


@query("k07_nested_report", "SELECT event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n, round(max(value), 9) AS best FROM events GROUP BY 1, 2")
def k07(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("p", F.from_json("props", "map<string, int>"))
    return e.select("event_type", "value", F.explode("p").alias("key", "k")).where("key = 'k'").groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("value"), 9).alias("best"))


@query("f19_completeness", "SELECT l_suppkey AS genome, round(count(DISTINCT p_brand) * 100 / (SELECT count(DISTINCT p_brand) FROM part), 6) AS percent, CASE WHEN count(DISTINCT p_brand) * 100 / (SELECT count(DISTINCT p_brand) FROM part) >= 95 THEN 'pass' ELSE 'fail' END AS state FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def f19(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    total = p.agg(F.countDistinct("p_brand").alias("total"))
    g = li.join(p, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("l_suppkey").alias("genome")).agg(F.countDistinct("p_brand").alias("n")).join(F.broadcast(total))
    share = F.col("n") * 100 / F.col("total")
    return g.select("genome", F.round(share, 6).alias("percent"), F.when(share >= 95, "pass").otherwise("fail").alias("state"))


@query("f10_duplicate_loci", "SELECT l_orderkey AS locus, arg_max(l_partkey, (l_quantity, l_partkey)) AS kept, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def f10(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("locus")).agg(F.max_by("l_partkey", F.struct("l_quantity", "l_partkey")).alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1")


@query("f12_referential_checks", "SELECT 'order without customer' AS problem, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'customer without order', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def f12(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    n = lambda df, what: df.agg(F.lit(what).alias("problem"), F.count(F.lit(1)).alias("n"))
    return n(o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left_anti"), "order without customer").union(n(c.join(o, F.col("o_custkey") == F.col("c_custkey"), "left_anti"), "customer without order"))


@query("a26_percentile_table", "WITH v AS (SELECT c_nationkey AS grp, list_sort(list(c_acctbal)) AS v FROM customer GROUP BY 1), p AS (SELECT grp, v, len(v) AS n, unnest([5, 25, 50, 75, 95]) AS percent FROM v) SELECT grp, percent, v[greatest(CAST(floor(percent * n / 100 + 0.499::DOUBLE) AS INTEGER), 1)] AS value FROM p")
def a26(spark, sf_dir):
    v = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("grp")).agg(F.array_sort(F.collect_list("c_acctbal")).alias("v"))
    p = v.select("grp", "v", F.explode(F.array(*(F.lit(x) for x in (5, 25, 50, 75, 95)))).alias("percent"))
    at = F.greatest(F.floor(F.col("percent") * F.size("v") / 100 + 0.499).cast("int"), F.lit(1))
    return p.select("grp", "percent", F.element_at("v", at).alias("value"))


@query("a27_resource_summary", "SELECT event_type AS step, round(avg(value), 6) AS mean, round(median(value), 6) AS median, round(sum(value), 4) AS total, max(value) AS most FROM events GROUP BY 1")
def a27(spark, sf_dir):
    v = F.col("value")
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("step")).agg(F.round(F.avg(v), 6).alias("mean"), F.round(F.median(v), 6).alias("median"), F.round(F.sum(v), 4).alias("total"), F.max(v).alias("most"))


@query("w16_kth_difference", "SELECT c_custkey, round(c_acctbal - lag(c_acctbal, 5) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey), 6) AS difference FROM customer")
def w16(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("c_nationkey").orderBy("c_acctbal", "c_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(F.col("c_acctbal") - F.lag("c_acctbal", 5).over(w), 6).alias("difference"))


@query("a41_n50", "WITH r AS (SELECT lang AS genome, length(text) AS n, sum(length(text)) OVER (PARTITION BY lang ORDER BY length(text) DESC, doc_id ROWS UNBOUNDED PRECEDING) AS run, sum(length(text)) OVER (PARTITION BY lang) AS total FROM documents) SELECT genome, max(CASE WHEN run * 2 >= total THEN n END) AS n50, count(*) AS contigs, CAST(max(total) AS BIGINT) AS total FROM r GROUP BY 1")
def a41(spark, sf_dir):
    from pyspark.sql import Window

    n = table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("genome"), F.length("text").alias("n")).agg(F.count(F.lit(1)).alias("c"))  # distinct lengths only
    w = Window.partitionBy("genome")
    r = n.withColumn("run", F.sum(F.col("n") * F.col("c")).over(w.orderBy(F.col("n").desc()))).withColumn("total", F.sum(F.col("n") * F.col("c")).over(w))
    return r.groupBy("genome").agg(F.max(F.when(F.col("run") * 2 >= F.col("total"), F.col("n"))).alias("n50"), F.sum("c").alias("contigs"), F.max("total").alias("total"))
