"""Queries over hit tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import hits as H
from ..operators.graph import settle
from .registry import query
from .standin import HITS, hits, table

WITH = f"WITH {HITS}"
PAIRS = f"{WITH}, pairs AS (SELECT qid, sid, qgenome, sgenome, max(bits) AS score FROM hits GROUP BY ALL)"
BOUND = f"""{PAIRS}, sides AS (SELECT qid AS id, qgenome AS genome, score FROM pairs UNION ALL SELECT sid, sgenome, score FROM pairs), top AS (SELECT id, genome, max(score) AS top FROM sides GROUP BY ALL),
selfs AS (SELECT id, genome, coalesce(score, top) AS self FROM top LEFT JOIN pairs ON qid = id AND sid = id),
bound AS (SELECT qid, sid, qgenome, sgenome, least(score, self) AS score FROM pairs JOIN selfs ON qid = id WHERE qid <> sid UNION ALL SELECT id, id, genome, genome, self FROM selfs)"""
SYM = f"""{BOUND}, sym AS (SELECT * FROM bound UNION ALL SELECT b.sid, b.qid, b.sgenome, b.qgenome, least(b.score, self) FROM bound b JOIN selfs ON id = b.sid WHERE b.qid <> b.sid AND NOT EXISTS (SELECT 1 FROM bound x WHERE x.qid = b.sid AND x.sid = b.qid))"""
BSR = f"""{SYM}, norms AS (SELECT qid, sid, qgenome, sgenome, least(score, self) / self AS norm FROM sym JOIN selfs ON qid = id WHERE qid <> sid),
bsr AS (SELECT n.*, (n.norm + m.norm) / 2 AS bsr FROM norms n JOIN norms m ON n.qid = m.sid AND n.sid = m.qid)"""
BEST = f"""{BSR}, ranked AS (SELECT *, row_number() OVER w AS r, lead(bsr, 1, 0) OVER w AS second FROM bsr WHERE qgenome <> sgenome WINDOW w AS (PARTITION BY qid, sgenome ORDER BY bsr DESC, sid)),
best AS (SELECT qid, sid, qgenome, sgenome, norm, bsr, second FROM ranked WHERE r = 1 AND 0.95::DOUBLE * bsr > second)"""


def pairs(spark, sf_dir):
    return H.best_per_pair(hits(spark, sf_dir))


def ratios(spark, sf_dir):
    return H.score_ratios(pairs(spark, sf_dir))


@query("f01_filter_hits", f"{WITH}, b AS (SELECT *, min(evalue) OVER (PARTITION BY qid) AS m FROM hits WHERE pid >= 60) SELECT * EXCLUDE m FROM b WHERE NOT (evalue > 1e-5::DOUBLE AND evalue > 10.0::DOUBLE * m)")
def f01(spark, sf_dir):
    return H.filter_hits(hits(spark, sf_dir), 60)


@query("f02_top_fraction", f"{WITH}, b AS (SELECT *, max(bits) OVER (PARTITION BY qid, sgenome) AS m FROM hits) SELECT * EXCLUDE m FROM b WHERE bits >= 0.8::DOUBLE * m")
def f02(spark, sf_dir):
    return H.top_fraction(hits(spark, sf_dir))


@query(
    "f03_full_length",
    """SELECT o_orderkey AS id, l_linenumber AS part, (s <= 21 AND 60 - e <= 20 AND s <= 21 AND 55 - e <= 20 AND (e - s + 1) * 100 >= 80.0 * 60 AND (e - s + 1) * 100 >= 80.0 * 55) AS full_length
FROM (SELECT o_orderkey, l_linenumber, l_suppkey % 30 + 1 AS s, 25 + CAST(l_quantity AS INTEGER) AS e FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
)
def f03(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    s, e = F.col("l_suppkey") % 30 + 1, F.lit(25) + F.col("l_quantity").cast("int")
    return li.select(F.col("o_orderkey").alias("id"), F.col("l_linenumber").alias("part"), H.full_length(F.lit(60), F.lit(55), s, e, s, e).alias("full_length"))


@query("a02_best_per_pair", f"{PAIRS} SELECT * FROM pairs")
def a02(spark, sf_dir):
    return pairs(spark, sf_dir)


@query("f04_bounded_self_hits", f"{BOUND} SELECT * FROM bound")
def f04(spark, sf_dir):
    return H.bounded(pairs(spark, sf_dir))


@query("j02_symmetric_pairs", f"{SYM} SELECT * FROM sym")
def j02(spark, sf_dir):
    return H.symmetric(H.bounded(pairs(spark, sf_dir)))


@query("a01_blast_score_ratio", f"{BSR} SELECT qid, sid, qgenome, sgenome, round(norm, 9) AS norm, round(bsr, 9) AS bsr FROM bsr")
def a01(spark, sf_dir):
    return ratios(spark, sf_dir).withColumns({c: F.round(c, 9) for c in ("norm", "bsr")})


@query("a03_best_two", f"{PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY qid, sgenome ORDER BY score DESC, sid) AS r FROM pairs) SELECT qid, sgenome, max(score) AS best, max(CASE WHEN r = 2 THEN score ELSE 0 END) AS second FROM r WHERE r <= 2 GROUP BY ALL")
def a03(spark, sf_dir):
    return H.best_two(pairs(spark, sf_dir))


@query("w02_best_strict", f"{BEST} SELECT qid, sid, round(bsr, 9) AS bsr, round(second, 9) AS second FROM best")
def w02(spark, sf_dir):
    return H.best_match(ratios(spark, sf_dir)).select("qid", "sid", F.round("bsr", 9).alias("bsr"), F.round("second", 9).alias("second"))


@query("w03_best_not_strict", f"{BEST.replace('bsr > second)', 'bsr >= second)')} SELECT qid, sid, round(bsr, 9) AS bsr FROM best")
def w03(spark, sf_dir):
    return H.best_match(ratios(spark, sf_dir), strict=False).select("qid", "sid", F.round("bsr", 9).alias("bsr"))


@query("j03_reciprocal_best", f"{BEST} SELECT a.qid, a.sid, round(a.bsr, 9) AS bsr FROM best a JOIN best b ON a.qid = b.sid AND a.sid = b.qid")
def j03(spark, sf_dir):
    return H.reciprocal(H.best_match(ratios(spark, sf_dir))).select("qid", "sid", F.round("bsr", 9).alias("bsr"))


_HIST = "SELECT g.bin, coalesce(n, 0) AS n, coalesce(n, 0) / sum(coalesce(n, 0)) OVER () AS share FROM (SELECT CAST(unnest(range(101)) AS INTEGER) AS bin) g LEFT JOIN (SELECT CAST(floor({0} * 100) AS INTEGER) AS bin, count(*) AS n FROM {1} GROUP BY 1) h ON g.bin = h.bin"


@query("w04_score_histogram", f"{BEST}, h AS ({_HIST.format('bsr', 'best')}) SELECT bin, n, round(share, 9) AS share FROM h")
def w04(spark, sf_dir):
    return H.score_histogram(H.best_match(ratios(spark, sf_dir)), "bsr").withColumn("share", F.round("share", 9))


@query(
    "w05_cutoff",
    f"""{BEST}, hb AS ({_HIST.format('bsr', 'best')}), hs AS ({_HIST.format('second', 'best')}), c AS (SELECT hb.bin, sum(hb.share - 3 * hs.share) OVER (ORDER BY hb.bin DESC ROWS UNBOUNDED PRECEDING) AS gain FROM hb JOIN hs ON hb.bin = hs.bin),
t AS (SELECT bin, round(gain, 9) AS gain FROM c ORDER BY round(gain, 9) DESC, bin DESC LIMIT 1) SELECT least(CASE WHEN gain > 0 THEN bin / 100 ELSE 1.0 END, 0.95)::DOUBLE AS cutoff FROM t""",
)
def w05(spark, sf_dir):
    return H.best_cutoff(H.best_match(ratios(spark, sf_dir)))


@query("f05_weak_matches", f"{WITH} SELECT qid, sid, pid, len FROM hits WHERE NOT (pid < 90 AND len / 60.0 < 0.5)")
def f05(spark, sf_dir):
    return hits(spark, sf_dir).where("not (pid < 90 and len / 60.0 < 0.5)").select("qid", "sid", "pid", "len")


@query("f06_relative_best", f"{WITH}, r AS (SELECT *, row_number() OVER w AS rank, first_value(bits) OVER w AS best FROM hits WINDOW w AS (PARTITION BY sid ORDER BY bits DESC, pid DESC, qid)) SELECT sid, qid, bits, rank FROM r WHERE bits = best OR (rank <= 5 AND bits > 0.95::DOUBLE * best)")
def f06(spark, sf_dir):
    return H.relative_best(hits(spark, sf_dir)).select("sid", "qid", "bits", "rank")


@query("f07_half_of_best", f"{WITH}, r AS (SELECT *, max(bits) OVER (PARTITION BY qid) AS t FROM hits) SELECT * EXCLUDE t FROM r WHERE bits >= 0.5::DOUBLE * t AND pid >= 90")
def f07(spark, sf_dir):
    return H.half_of_best(hits(spark, sf_dir))


@query("t02_top_targets", f"{PAIRS}, r AS (SELECT qid, sid, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, sid) AS rank FROM pairs) SELECT * FROM r WHERE rank <= 5")
def t02(spark, sf_dir):
    return H.top_k(pairs(spark, sf_dir), 5, "score").select("qid", "sid", "score", "rank")


@query("f13_missing_features", f"{WITH} SELECT id, CASE WHEN q IS NULL AND s IS NULL THEN 'neither' WHEN q IS NULL THEN 'never a query' ELSE 'never a subject' END AS state FROM (SELECT p_partkey AS id FROM part) LEFT JOIN (SELECT DISTINCT qid AS id, 1 AS q FROM hits) USING (id) LEFT JOIN (SELECT DISTINCT sid AS id, 1 AS s FROM hits) USING (id) WHERE q IS NULL OR s IS NULL")
def f13(spark, sf_dir):
    return H.missing_features(hits(spark, sf_dir), table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id")))


@query("t04_medoids", f"{BSR}, m AS (SELECT DISTINCT qid AS id, qid % 40 AS cluster FROM bsr), t AS (SELECT a.cluster, qid, round(sum(bsr), 9) AS total FROM bsr JOIN m a ON a.id = qid JOIN m b ON b.id = sid AND a.cluster = b.cluster GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY total DESC, qid) AS r FROM t) SELECT cluster, qid AS medoid, round(total, 6) AS total FROM r WHERE r = 1")
def t04(spark, sf_dir):
    b = settle(ratios(spark, sf_dir).select("qid", "sid", "bsr"))
    return H.medoids(b, b.select(F.col("qid").alias("id"), (F.col("qid") % 40).alias("cluster")).distinct()).withColumn("total", F.round("total", 6))


@query("a08_genome_identity", f"{WITH}, o AS (SELECT qgenome AS g1, sgenome AS g2, sum(len * pid) / sum(len) AS x FROM hits GROUP BY 1, 2), b AS (SELECT * FROM o UNION ALL SELECT g2, g1, x FROM o) SELECT g1, g2, round(avg(x), 9) AS identity FROM b GROUP BY 1, 2")
def a08(spark, sf_dir):
    return H.genome_identity(hits(spark, sf_dir)).withColumn("identity", F.round("identity", 9))


@query("a07_paralog_weights", f"{WITH}, p AS (SELECT DISTINCT least(qid, sid) AS a, greatest(qid, sid) AS b FROM hits WHERE pid >= 95) SELECT least(a % 50, b % 50) AS c1, greatest(a % 50, b % 50) AS c2, count(*) AS n FROM p WHERE a % 50 <> b % 50 GROUP BY 1, 2")
def a07(spark, sf_dir):
    h = hits(spark, sf_dir).where("pid >= 95")
    ids = h.select(F.explode(F.array("qid", "sid")).alias("id")).distinct()
    return H.paralog_weights(h, ids.select("id", (F.col("id") % 50).alias("cluster")))


@query("a40_raw_and_used", f"{WITH} SELECT qgenome AS genome, count(DISTINCT qid) AS raw, count(DISTINCT CASE WHEN pid >= 98 THEN qid END) AS used FROM hits GROUP BY 1")
def a40(spark, sf_dir):
    return hits(spark, sf_dir).groupBy(F.col("qgenome").alias("genome")).agg(F.countDistinct("qid").alias("raw"), F.countDistinct(F.when(F.col("pid") >= 98, F.col("qid"))).alias("used"))


@query("a05_cluster_weights", f"{PAIRS}, c AS (SELECT qid % 40 AS cluster, count(DISTINCT qid) AS n, count(*) FILTER (score >= 50000) AS strong, avg(score) AS mean_score FROM pairs GROUP BY 1) SELECT cluster, n, round(strong * 100 / (n * (n - 1) / 2), 6) AS percent_strong, round(mean_score, 6) AS mean_score FROM c WHERE n > 1")
def a05(spark, sf_dir):
    p = pairs(spark, sf_dir).groupBy((F.col("qid") % 40).alias("cluster")).agg(F.countDistinct("qid").alias("n"), F.sum((F.col("score") >= 50000).cast("int")).alias("strong"), F.avg("score").alias("m"))
    return p.where("n > 1").select("cluster", "n", F.round(F.col("strong") * 100 / (F.col("n") * (F.col("n") - 1) / 2), 6).alias("percent_strong"), F.round("m", 6).alias("mean_score"))


@query("f21_strict_orthologs", """SELECT m AS mode, count(*) AS n FROM (SELECT unnest(['N', 'M', 'Y']) AS m, l_partkey % 25 AS qg, l_suppkey % 25 AS sg, l_linenumber % 2 = 0 AS bb, l_partkey % 3 = 0 AS sb, l_suppkey % 7 = 0 AS anc, l_suppkey % 11 = 0 AS ext, CAST(l_quantity AS INTEGER) % 5 AS cgn, l_discount > 0.05 AS cut FROM lineitem)
WHERE qg <> sg AND (bb OR sb) AND (m = 'N' OR anc OR ext OR cgn > 3 OR (m = 'Y' AND cut AND (bb OR cgn > 1))) GROUP BY 1""")
def f21(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    c = F.col
    r = {"qgenome": c("l_partkey") % 25, "sgenome": c("l_suppkey") % 25, "bibest": c("l_linenumber") % 2 == 0, "synbibest": c("l_partkey") % 3 == 0, "anchor": c("l_suppkey") % 7 == 0, "extend": c("l_suppkey") % 11 == 0, "cgn": c("l_quantity").cast("int") % 5, "window": F.lit(3), "above_cut": c("l_discount") > 0.05}
    flags = F.explode(F.array(*(F.struct(F.lit(m).alias("mode"), H.strict_ortholog(m, r).alias("ok")) for m in "NMY")))
    return li.select(flags.alias("f")).where("f.ok").groupBy(F.col("f.mode").alias("mode")).agg(F.count(F.lit(1)).alias("n"))
