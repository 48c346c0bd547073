"""Further queries: neighbourhood scores, island joins, fits, checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import hits as H
from ..operators import membership as M
from ..operators import synteny as Y
from .hits import PAIRS, pairs
from .registry import query
from .standin import FEATURES, HITS, INTERVALS, MEMBERS, features, intervals, members, table

REL = f"""{PAIRS}, r AS (SELECT qid, sid, row_number() OVER (PARTITION BY qid ORDER BY score DESC, sid) AS k FROM pairs), rel AS (SELECT qid, sid, CASE WHEN k <= 2 THEN 1 ELSE 0 END AS best, CASE WHEN k = 1 THEN 1 ELSE 0 END AS bibest FROM r WHERE k <= 6),
place AS (SELECT p_partkey AS id, p_partkey % 25 AS contig, p_partkey // 25 AS pos, CASE WHEN p_size % 2 = 0 THEN 1 ELSE -1 END AS orient FROM part)"""


def _relations(spark, sf_dir):
    r = H.top_k(pairs(spark, sf_dir), 6, "score")
    rel = r.select("qid", "sid", (F.col("rank") <= 2).cast("int").alias("best"), (F.col("rank") == 1).cast("int").alias("bibest"))
    p = table(spark, sf_dir, "part")
    return rel, p.select(F.col("p_partkey").alias("id"), (F.col("p_partkey") % 25).alias("contig"), F.floor(F.col("p_partkey") / 25).alias("pos"), F.when(F.col("p_size") % 2 == 0, 1).otherwise(-1).alias("orient"))


@query(
    "j04_synteny_scores",
    f"""{REL}, f AS (SELECT rel.*, q.contig AS qc, q.pos AS qp, q.orient AS qo, s.contig AS sc, s.pos AS sp, s.orient AS so FROM rel JOIN place q ON q.id = qid JOIN place s ON s.id = sid),
j AS (SELECT a.qid, a.sid, b.qp - a.qp AS i, b.sp - a.sp AS j, b.sid AS nbr, b.bibest, CAST((1 + 2 * b.best + 5 * b.best * b.bibest + CASE WHEN b.qo * b.so = a.qo * a.so THEN 1 ELSE 0 END + CASE WHEN sign(b.qp - a.qp) * a.qo = sign(b.sp - a.sp) * a.so THEN 1 ELSE 0 END
 + (4 - abs(abs(b.qp - a.qp) - abs(b.sp - a.sp)))) * pow(3, 4 - greatest(abs(b.qp - a.qp), abs(b.sp - a.sp))) AS BIGINT) AS v FROM f a JOIN f b ON a.qc = b.qc AND a.sc = b.sc AND abs(b.qp - a.qp) BETWEEN 1 AND 3 AND abs(b.sp - a.sp) BETWEEN 1 AND 3),
w AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY qid, sid, i ORDER BY v DESC, abs(j), j) = 1), n AS (SELECT qid, sid, nbr, max(v) AS v, sum(bibest) AS b FROM w GROUP BY 1, 2, 3) SELECT qid, sid, CAST(sum(v) AS BIGINT) AS score, CAST(sum(b) AS BIGINT) AS winners FROM n GROUP BY 1, 2""",
)
def j04(spark, sf_dir):
    return Y.synteny_scores(*_relations(spark, sf_dir), 3)


@query("j07_overlap_table")
def j07(spark, sf_dir):
    i = intervals(spark, sf_dir).groupBy("contig", "start", "stop", "name").agg(F.min("kind").alias("species"))
    return Y.overlap_table(i, ["A", "N", "R"], 200)


@query("w11_plateaus")
def w11(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("contig"), F.col("event_id").alias("pos"), F.col("value").cast("double").alias("value"))
    return Y.smoothed_plateaus(e)


@query("x14_alignments")
def x14(spark, sf_dir):
    """Each item, whole, within the next one's text."""
    b = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("query"))
    return Y.alignments(b.join(b.select((F.col("id") - 1).alias("id"), F.col("query").alias("subject")), "id"))


@query("w12_quantile_thresholds", f"{PAIRS}, r AS (SELECT qgenome, row_number() OVER w AS k, score, coalesce(lead(score) OVER w, 0) AS second FROM pairs WINDOW w AS (PARTITION BY qid ORDER BY score DESC, sid)), v AS (SELECT qgenome, list_sort(list(score)) AS b, list_sort(list(second)) AS s FROM r WHERE k = 1 GROUP BY 1) SELECT qgenome AS genome, b[len(b) // 2 + 1] AS median_best, (b[len(b) // 4 + 1] + s[len(s) - len(s) // 4]) / 2 AS threshold FROM v")
def w12(spark, sf_dir):
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), "sid")
    r = pairs(spark, sf_dir).withColumns({"k": F.row_number().over(w), "second": F.coalesce(F.lead("score").over(w), F.lit(0.0))}).where("k = 1")
    v = r.groupBy(F.col("qgenome").alias("genome")).agg(F.array_sort(F.collect_list("score")).alias("b"), F.array_sort(F.collect_list("second")).alias("s"))
    part = lambda c, d: F.floor(F.size(c) / d).cast("int")
    return v.select("genome", F.element_at("b", part("b", 2) + 1).alias("median_best"), ((F.element_at("b", part("b", 4) + 1) + F.element_at("s", F.size("s") - part("s", 4))) / 2).alias("threshold"))


@query("a24_pan_fit", f"""WITH {MEMBERS}, n AS (SELECT cluster, count(*) AS n FROM members GROUP BY 1), s AS (SELECT n AS x, count(*) AS y FROM n GROUP BY 1) SELECT round(regr_slope(ln(y), ln(x)), 6) AS exponent, round(exp(regr_intercept(ln(y), ln(x))), 4) AS factor, round(regr_r2(ln(y), ln(x)), 6) AS r2 FROM s""")
def a24(spark, sf_dir):
    s = M.size_breakdown(members(spark, sf_dir)).select(F.log("n_genomes").alias("x"), F.log("clusters").alias("y"))
    return s.agg(F.round(F.regr_slope("y", "x"), 6).alias("exponent"), F.round(F.exp(F.regr_intercept("y", "x")), 4).alias("factor"), F.round(F.regr_r2("y", "x"), 6).alias("r2"))


@query("f23_genome_sizes", f"WITH {MEMBERS}, n AS (SELECT genome, count(*) AS n FROM members GROUP BY 1) SELECT genome, n, n < 0.98::DOUBLE * (SELECT avg(n) FROM n) AS small FROM n")
def f23(spark, sf_dir):
    n = members(spark, sf_dir).groupBy("genome").agg(F.count(F.lit(1)).alias("n"))
    return n.join(F.broadcast(n.agg(F.avg("n").alias("mean")))).select("genome", "n", (F.col("n") < 0.98 * F.col("mean")).alias("small"))


@query("j15_island_annotations", f"WITH {MEMBERS} SELECT p_brand AS fgi, p_type AS annotation, count(DISTINCT genome) AS genomes FROM part JOIN members ON cluster = p_partkey GROUP BY 1, 2")
def j15(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cluster"), F.col("p_brand").alias("fgi"), F.col("p_type").alias("annotation"))
    return members(spark, sf_dir).join(p, "cluster").groupBy("fgi", "annotation").agg(F.countDistinct("genome").alias("genomes"))


@query("j16_island_membership", f"WITH {MEMBERS}, m AS (SELECT DISTINCT p_brand AS fgi, genome FROM members JOIN part ON cluster = p_partkey) SELECT b.fgi, n_nationkey AS genome, m.genome IS NOT NULL AS present FROM (SELECT DISTINCT p_brand AS fgi FROM part) b CROSS JOIN nation LEFT JOIN m ON m.fgi = b.fgi AND m.genome = n_nationkey")
def j16(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    m = members(spark, sf_dir).join(p.select(F.col("p_partkey").alias("cluster"), F.col("p_brand").alias("fgi")), "cluster")
    got = m.groupBy("fgi").agg(F.collect_set("genome").alias("have"))
    every = table(spark, sf_dir, "nation").agg(F.collect_list("n_nationkey").alias("every"))  # the genome list, one row
    fgi = p.select(F.col("p_brand").alias("fgi")).distinct().join(got, "fgi", "left").join(F.broadcast(every))
    return fgi.select("fgi", "have", F.explode("every").alias("genome")).select("fgi", "genome", F.coalesce(F.array_contains("have", F.col("genome")), F.lit(False)).alias("present"))


@query("j18_restrict_to_ids", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 7)")
def j18(spark, sf_dir):
    ids = table(spark, sf_dir, "part").where("p_size = 7").select(F.col("p_partkey").alias("l_partkey"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity").join(ids, "l_partkey", "left_semi").select("l_orderkey", "l_partkey", "l_quantity")


@query("j20_rekeyed_edges", f"WITH {FEATURES}, e AS (SELECT cluster AS a, lead(cluster) OVER (PARTITION BY contig ORDER BY pos) AS b FROM features), x AS (SELECT cluster AS old, min(feat) AS new FROM features WHERE cluster LIKE '%1' GROUP BY 1) SELECT coalesce(CAST(p.new AS VARCHAR), a) AS c1, coalesce(CAST(q.new AS VARCHAR), b) AS c2, count(*) AS n FROM e LEFT JOIN x p ON p.old = a LEFT JOIN x q ON q.old = b WHERE b IS NOT NULL GROUP BY 1, 2")
def j20(spark, sf_dir):
    from ..operators.order import neighbours

    f = features(spark, sf_dir)
    e = neighbours(f, ["contig"], ["pos"], "cluster").select(F.col("cluster").alias("a"), F.col("next").alias("b")).where("b is not null")
    x = f.where(F.col("cluster").like("%1")).groupBy("cluster").agg(F.min("feat").cast("string").alias("new"))
    e = e.join(x.select(F.col("cluster").alias("a"), F.col("new").alias("na")), "a", "left").join(x.select(F.col("cluster").alias("b"), F.col("new").alias("nb")), "b", "left")
    return e.groupBy(F.coalesce("na", "a").alias("c1"), F.coalesce("nb", "b").alias("c2")).agg(F.count(F.lit(1)).alias("n"))


@query("a33_clusters_of_four", "SELECT m AS method, count(*) AS clusters FROM (SELECT 'supplier' AS m, l_partkey FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey % 5) = 4 UNION ALL SELECT 'flag', l_partkey FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_returnflag || l_linestatus) = 4) GROUP BY 1")
def a33(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    one = lambda n, c: li.groupBy("l_partkey").agg(F.countDistinct(c).alias("n")).where("n = 4").select(F.lit(n).alias("method"))
    return one("supplier", F.col("l_suppkey") % 5).union(one("flag", F.concat("l_returnflag", "l_linestatus"))).groupBy("method").agg(F.count(F.lit(1)).alias("clusters"))


@query("a44_allele_dedup", "WITH s AS (SELECT lang AS cluster, length(text) AS n, min(doc_id) AS id FROM documents GROUP BY lang, text), v AS (SELECT cluster, median(n) AS m, quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.75) AS q3 FROM s GROUP BY 1) SELECT s.cluster, id, n FROM s JOIN v USING (cluster) WHERE n BETWEEN q1 - 0.1::DOUBLE * m AND q3 + 0.1::DOUBLE * m")
def a44(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    s = d.groupBy(F.col("lang").alias("cluster"), F.md5("text").alias("h")).agg(F.min("doc_id").alias("id"), F.first(F.length("text")).alias("n"))
    v = s.groupBy("cluster").agg(F.percentile("n", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
    q = lambda k: F.get("q", F.lit(k))
    return s.join(F.broadcast(v), "cluster").where(F.col("n").between(q(0) - 0.1 * q(1), q(2) + 0.1 * q(1))).select("cluster", "id", "n")


@query("f17_role_predicates", f"WITH {MEMBERS} SELECT cluster, max(CASE WHEN regexp_matches(p_type, 'STEEL|BRASS') THEN 1 ELSE 0 END) = 1 AS metal, max(CASE WHEN regexp_matches(p_name, 'red|blue') THEN 1 ELSE 0 END) = 1 AS coloured FROM members JOIN part ON cluster = p_partkey GROUP BY 1")
def f17(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cluster"), F.col("p_type").rlike("STEEL|BRASS").alias("metal"), F.col("p_name").rlike("red|blue").alias("coloured"))
    return members(spark, sf_dir).join(p, "cluster").groupBy("cluster").agg(F.max("metal").alias("metal"), F.max("coloured").alias("coloured"))


@query("k02_pairwise_matrix", f"""WITH {MEMBERS}, p AS (SELECT a.genome AS a, b.genome AS b, count(*) AS n FROM members a JOIN members b ON a.cluster = b.cluster GROUP BY 1, 2) SELECT CAST(a AS VARCHAR) AS name, {", ".join(f"max(CASE WHEN b = {g} THEN n END) AS g{g}" for g in range(25))} FROM p GROUP BY a""")
def k02(spark, sf_dir):
    s = M.pairwise_shared(members(spark, sf_dir)).select("g1", "g2", "shared")
    own = members(spark, sf_dir).groupBy("genome").agg(F.count(F.lit(1)).alias("shared")).select("genome", F.col("genome").alias("g2"), "shared")
    long = s.union(s.select("g2", "g1", "shared")).union(own)
    wide = long.groupBy(F.col("g1").cast("string").alias("name")).pivot("g2", list(range(25))).agg(F.max("shared"))
    return wide.select("name", *(F.col(str(g)).alias(f"g{g}") for g in range(25)))


@query("s06_hit_summary", f"WITH {HITS} SELECT qgenome, sgenome, count(*) AS n, max(bits) AS best, min(evalue) AS least FROM hits GROUP BY 1, 2")
def s06(spark, sf_dir):
    from .standin import hits

    return hits(spark, sf_dir).groupBy("qgenome", "sgenome").agg(F.count(F.lit(1)).alias("n"), F.max("bits").alias("best"), F.min("evalue").alias("least"))


@query("f11_duplicate_coordinates", f"WITH {INTERVALS} SELECT contig, start, stop, count(*) AS n, min(part) AS first_part FROM intervals GROUP BY 1, 2, 3 HAVING count(*) > 1")
def f11(spark, sf_dir):
    return intervals(spark, sf_dir).groupBy("contig", "start", "stop").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("first_part")).where("n > 1")


@query(
    "g07_island_paths",
    f"""WITH {FEATURES}, f AS (SELECT *, count(CASE WHEN cluster LIKE '%_7' OR cluster LIKE '%5' THEN 1 END) OVER (PARTITION BY contig ORDER BY pos) AS k FROM features), r AS (SELECT contig, genome, k, list(cluster ORDER BY pos) AS m FROM f WHERE k > 0 GROUP BY 1, 2, 3),
p AS (SELECT genome, m[1] AS "left", lead(m[1]) OVER (PARTITION BY contig ORDER BY k) AS "right", array_to_string(m[2:], ',') AS path FROM r) SELECT "left", "right", path, count(DISTINCT genome) AS genomes, count(*) AS n FROM p WHERE "right" IS NOT NULL GROUP BY 1, 2, 3""",
)
def g07(spark, sf_dir):
    from ..operators import regions as Z

    f = features(spark, sf_dir)
    core = f.where(F.col("cluster").like("%_7") | F.col("cluster").like("%5")).select("cluster").distinct()
    return Z.island_paths(f, core, ["pos"])


@query(
    "j08_region_suppression",
    f"""WITH {INTERVALS}, d AS (SELECT contig, start, stop, name, max(part) AS bits FROM intervals GROUP BY ALL), h AS (SELECT *, bits % 40 AS cluster, bits % 100 AS pid, bits % 40 + 1 AS size, bits % 3 = 0 AS best FROM d),
p AS (SELECT l.name, l.cluster = r.cluster AS twin, l.bits AS lb, r.bits AS rb, l.name > r.name AS later, l.size AS ls, r.size AS rs, l.pid AS lp, r.pid AS rp, (least(l.stop, r.stop) - greatest(l.start, r.start) + 1) / least(l.stop - l.start + 1, r.stop - r.start + 1) AS share
 FROM h l JOIN h r ON l.contig = r.contig AND l.name <> r.name AND l.start <= r.stop AND r.start <= l.stop),
x AS (SELECT name, twin AND share > 0.3::DOUBLE AND (lb < rb OR lb = rb AND later) AS t, NOT twin AND share > 0.45::DOUBLE AND lb <= 0.98::DOUBLE * rb AS v, ls = 1 OR ls * 10 <= rs OR lp + 5 <= rp AS w FROM p), lost AS (SELECT name, max(CASE WHEN t OR v AND w THEN 1 ELSE 0 END) = 1 AS weak FROM x WHERE t OR v GROUP BY 1)
SELECT h.contig, h.start, h.stop, h.name, bits, cluster, pid, size, best FROM h LEFT JOIN lost USING (name) WHERE weak IS NULL OR best AND NOT weak""",
)
def j08(spark, sf_dir):
    from ..operators import regions as Z

    d = intervals(spark, sf_dir).groupBy("contig", "start", "stop", "name").agg(F.max("part").alias("bits"))
    b = F.col("bits")
    h = d.withColumns({"cluster": b % 40, "pid": b % 100, "size": b % 40 + 1, "best": b % 3 == 0})
    return Z.suppress_competitors(h, 200)
