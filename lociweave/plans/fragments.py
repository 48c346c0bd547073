"""Queries over fragments, diagonals, paralog penalties, refinement, and small joins and functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequence as S
from ..operators import fragments as P
from ..operators import graph as G
from ..operators import hits as H
from ..operators import membership as M
from ..operators import order as O
from ..operators import partition as D
from ..operators import trees as R
from .hits import BOUND, pairs
from .more import REL, _relations
from .order import EDGES, sizes
from .order import edges as feature_edges
from ..operators.graph import spread
from .registry import query
from .standin import HITS, INTERVALS, MEMBERS, features, hits, intervals, members, sequences, table


@query(
    "a06_fragment_labels",
    f"""WITH {HITS}, m AS (SELECT qid, sid, max(len) > 45 AS whole FROM hits WHERE qid <> sid GROUP BY 1, 2), mem AS (SELECT p_partkey AS feat, p_partkey % 3 AS cluster, p_size AS length FROM part),
mm AS (SELECT *, avg(length) OVER (PARTITION BY cluster) AS mean FROM mem), g AS (SELECT q.feat, q.cluster, q.length, q.mean, count(*) FILTER (q.cluster = s.cluster) AS inside, count(*) FILTER (q.cluster <> s.cluster) AS outside,
 count(*) FILTER (q.cluster = s.cluster AND whole) AS w, count(*) FILTER (q.cluster <> s.cluster AND s.length < q.length) AS shorter FROM m JOIN mm q ON q.feat = qid JOIN mem s ON s.feat = sid GROUP BY 1, 2, 3, 4),
l AS (SELECT feat, cluster, CASE WHEN length < 0.9::DOUBLE * mean AND 2 * w < inside THEN 'fragment in cluster' WHEN length > 1.1::DOUBLE * mean AND shorter > w AND shorter = outside AND shorter + w + 1 >= inside THEN 'fusion'
 WHEN outside > inside AND shorter = outside THEN 'fragment out of cluster' END AS label FROM g) SELECT * FROM l WHERE label IS NOT NULL""",
)
def a06(spark, sf_dir):
    m = hits(spark, sf_dir).groupBy("qid", "sid").agg((F.max("len") > 45).alias("full"))
    p = table(spark, sf_dir, "part")
    return P.fragment_labels(m, p.select(F.col("p_partkey").alias("feat"), (F.col("p_partkey") % 3).alias("cluster"), F.col("p_size").alias("length")))


@query(
    "a32_paralog_penalty",
    f"""{BOUND}, sc AS (SELECT qid AS gene, sid, max(floor(score)) AS score FROM bound GROUP BY 1, 2), me AS (SELECT 'brand' AS method, p_brand AS cluster, p_partkey AS gene FROM part UNION ALL SELECT 'size', CAST(p_size % 4 AS VARCHAR), p_partkey FROM part),
own AS (SELECT * FROM me WHERE gene IN (SELECT gene FROM sc WHERE gene = sid)), near AS (SELECT o.gene, o.method, s.sid, s.score FROM own o JOIN sc s ON s.gene = o.gene JOIN me m ON m.method = o.method AND m.cluster = o.cluster AND m.gene = s.sid),
d AS (SELECT x.gene, x.method AS a, y.method AS b FROM own x JOIN own y ON x.gene = y.gene), lone AS (SELECT d.gene, d.a, d.b, n.score FROM d JOIN near n ON n.gene = d.gene AND n.method = d.a WHERE NOT EXISTS (SELECT 1 FROM near k WHERE k.gene = d.gene AND k.method = d.b AND k.sid = n.sid)),
one AS (SELECT d.gene, d.a, d.b, coalesce(avg(score), 0) AS p FROM d LEFT JOIN lone USING (gene, a, b) GROUP BY 1, 2, 3) SELECT p.a, p.b, round(avg((p.p + q.p) / 2), 4) AS penalty, count(*) AS genes FROM one p JOIN one q ON p.gene = q.gene AND p.a = q.b AND p.b = q.a GROUP BY 1, 2""",
)
def a32(spark, sf_dir):
    scores = H.bounded(pairs(spark, sf_dir)).select("qid", "sid", F.floor("score").cast("double").alias("score"))
    p = table(spark, sf_dir, "part")
    one = lambda name, c: p.select(F.lit(name).alias("method"), c.cast("string").alias("cluster"), F.col("p_partkey").alias("gene"))
    got = P.paralog_penalty(one("brand", F.col("p_brand")).union(one("size", F.col("p_size") % 4)), scores)
    return got.select("a", "b", F.round("penalty", 4).alias("penalty"), "genes")


@query(
    "f08_outside_padding",
    """SELECT l_orderkey, l_linenumber, l_suppkey AS sid, l_linenumber * 10 AS sstart, l_linenumber * 10 + CAST(l_quantity AS INTEGER) AS send FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
WHERE NOT (s_nationkey % 2 = 0 AND (l_linenumber * 10 + CAST(l_quantity AS INTEGER) <= 30 OR l_linenumber * 10 > 60))""",
)
def f08(spark, sf_dir):
    start = F.col("l_linenumber") * 10
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("sid"), start.alias("sstart"), (start + F.col("l_quantity").cast("int")).alias("send"))
    c = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sid"), F.lit(30).alias("length"), F.lit(30).alias("padding"), (F.col("s_nationkey") % 2 == 0).alias("circular"))
    return P.outside_padding(li, c)


@query("f15_submatrix", f"WITH {MEMBERS} SELECT cluster, {', '.join(f'max(CASE WHEN genome = {g} THEN 1 ELSE 0 END) AS g{g}' for g in (2, 3, 5))} FROM members WHERE cluster IN (SELECT p_partkey FROM part WHERE p_size < 20) AND genome IN (2, 3, 5) GROUP BY 1")
def f15(spark, sf_dir):
    rows = table(spark, sf_dir, "part").where("p_size < 20").select(F.col("p_partkey").alias("cluster"))
    m = members(spark, sf_dir).where(F.col("genome").isin(2, 3, 5)).join(rows, "cluster", "left_semi")
    wide = m.groupBy("cluster").pivot("genome", [2, 3, 5]).agg(F.lit(1).alias("there"))
    return wide.select("cluster", *(F.coalesce(str(g), F.lit(0)).alias(f"g{g}") for g in (2, 3, 5)))


@query("f18_version_strip", "SELECT regexp_replace(p_brand || '.' || p_size, '\\.[0-9]+$', '') AS name, count(*) AS versions FROM part GROUP BY 1")
def f18(spark, sf_dir):
    name = F.regexp_replace(F.concat("p_brand", F.lit("."), F.col("p_size").cast("string")), r"\.[0-9]+$", "")
    return table(spark, sf_dir, "part").groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("versions"))


@query("f20_incomplete", "SELECT o_orderkey, o_orderkey % 7 + 1 AS expected, count(l_orderkey) AS counted, CASE WHEN count(l_orderkey) = 0 THEN 'missing' WHEN count(l_orderkey) < o_orderkey % 7 + 1 THEN 'incomplete' ELSE 'complete' END AS state FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def f20(spark, sf_dir):
    counted = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("counted"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 7 + 1).alias("expected")).join(counted, "o_orderkey", "left")
    n = F.coalesce("counted", F.lit(0))
    return o.select("o_orderkey", "expected", n.alias("counted"), F.when(n == 0, "missing").when(n < F.col("expected"), "incomplete").otherwise("complete").alias("state"))


@query("g06_consensus_lines")
def g06(spark, sf_dir):
    from .graphs import g05c

    return P.consensus_lines(g05c(spark, sf_dir))


@query("g09_median_partition")
def g09(spark, sf_dir):
    p = M.pairwise_shared(members(spark, sf_dir)).select(F.col("g1").alias("a"), F.col("g2").alias("b"), (1 - F.col("jaccard") / 100).alias("distance"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("node"), F.col("n_nationkey").alias("place"))
    return D.median_partition(n, p, 0.02)


@query("g19_fragment_groups")
def g19(spark, sf_dir):
    h = hits(spark, sf_dir).groupBy(F.col("sid").alias("qid"), F.col("qid").alias("sid")).agg(F.min("len").alias("start"), (F.min("len") + F.max("sgenome") % 5 + 8).alias("stop"))
    p = table(spark, sf_dir, "part")
    places = p.select(F.col("p_partkey").alias("feat"), (F.col("p_partkey") % 40).alias("contig"), F.floor(F.col("p_partkey") / 40).alias("pos"), (F.col("p_partkey") % 5).alias("genome"), F.col("p_size").alias("length"))
    return P.fragment_groups(h, places, p.select(F.col("p_partkey").alias("feat"), (F.col("p_size") % 4).alias("n")))


@query("j01_hit_attributes", f"WITH {HITS} SELECT q.p_brand AS qbrand, s.p_brand AS sbrand, count(*) AS n, max(pid) AS best FROM hits JOIN part q ON q.p_partkey = qid JOIN part s ON s.p_partkey = sid GROUP BY 1, 2")
def j01(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    side = lambda k: p.select(F.col("p_partkey").alias(f"{k}id"), F.col("p_brand").alias(f"{k}brand"))
    return hits(spark, sf_dir).join(side("q"), "qid").join(side("s"), "sid").groupBy("qbrand", "sbrand").agg(F.count(F.lit(1)).alias("n"), F.max("pid").alias("best"))


@query(
    "j05_extended_anchors",
    f"""{REL.replace("WITH", "WITH RECURSIVE", 1)}, node AS (SELECT qid, sid, bibest = 1 AS anchor, q.contig AS qc, s.contig AS sc, q.pos AS qp, s.pos AS sp, q.orient * s.orient AS own FROM rel JOIN place q ON q.id = qid JOIN place s ON s.id = sid),
bounds AS (SELECT contig AS qc, min(pos) AS low, max(pos) AS high FROM place GROUP BY 1), tries AS (SELECT * FROM (VALUES (0, 1, 1), (1, 2, 1), (2, 3, 1), (3, 1, 2), (4, 2, 2)) v(r, a, b), (VALUES (1), (-1)) x(d), (VALUES (1), (-1)) y(t)),
met AS (SELECT x.qid, x.sid, d, t, arg_min(y.qid, r) AS q2, arg_min(y.sid, r) AS s2, arg_min(y.anchor, r) AS stops FROM node x JOIN bounds ON bounds.qc = x.qc CROSS JOIN tries JOIN node y ON y.qc = x.qc AND y.sc = x.sc AND y.qp = x.qp + d * a AND y.sp = x.sp + d * t * b WHERE b = 1 OR x.qp + 3 * d BETWEEN low AND high GROUP BY 1, 2, 3, 4),
walk(qid, sid, d, t) AS (SELECT qid, sid, d, own FROM node, (VALUES (1), (-1)) x(d) WHERE anchor UNION SELECT q2, s2, m.d, m.t FROM walk w JOIN met m ON m.qid = w.qid AND m.sid = w.sid AND m.d = w.d AND m.t = w.t WHERE NOT stops)
SELECT qid, sid, anchor, NOT anchor AND (qid, sid) IN (SELECT (qid, sid) FROM walk) AS extended FROM node""",
)
def j05(spark, sf_dir):
    return P.extended_anchors(*_relations(spark, sf_dir), F.col("bibest") == 1)


@query("j11_cluster_member_attributes", "SELECT c_nationkey AS genome, p_brand AS brand, count(DISTINCT o_orderkey) AS loci, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2")
def j11(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    o = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey")).join(t("customer").select("c_custkey", F.col("c_nationkey").alias("genome")), "c_custkey")
    li = t("lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey")).join(t("part").select("p_partkey", F.col("p_brand").alias("brand")), "p_partkey")
    tasks = spread(t("lineitem"))  # orders lie in so many that the distinct ones of a task stay few
    return li.repartition(tasks, "l_orderkey").join(o.repartition(tasks, "l_orderkey"), "l_orderkey").groupBy("genome", "brand").agg(F.countDistinct("l_orderkey").alias("loci"), F.count(F.lit(1)).alias("n"))


@query("j22_pasted_columns", "WITH a AS (SELECT row_number() OVER (ORDER BY c_custkey) AS k, c_name FROM customer), b AS (SELECT row_number() OVER (ORDER BY p_partkey) AS k, p_name FROM part) SELECT k, c_name, p_name FROM a JOIN b USING (k)")
def j22(spark, sf_dir):
    numbered = lambda t, key, value: O.numbered(table(spark, sf_dir, t).select(key, value), key).select("k", value)
    return numbered("customer", "c_custkey", "c_name").join(numbered("part", "p_partkey", "p_name"), "k").select("k", "c_name", "p_name")


@query("t08_spaced_representatives")
def t08(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("type"), F.col("p_partkey").alias("node"), (F.col("p_retailprice") / 3000).alias("distance"))
    return D.spaced_representatives(p, 5, 0.01)


@query("t10_sorted_kmers", """WITH s AS (SELECT upper(regexp_replace(text, '[^acgtACGT]', '', 'g')) AS seq FROM documents), k AS (SELECT substr(seq, i, 6) AS kmer FROM (SELECT seq, unnest(range(1, length(seq) - 4)) AS i FROM s)),
c AS (SELECT least(kmer, reverse(translate(kmer, 'ACGT', 'TGCA'))) AS kmer, count(*) AS n FROM k GROUP BY 1) SELECT kmer, n, row_number() OVER (ORDER BY kmer) AS place FROM c""")
def t10(spark, sf_dir):
    k = sequences(spark, sf_dir).select(F.explode(S.kmers(F.col("seq"), 6)).alias("kmer")).select(S.canonical(F.col("kmer")).alias("kmer"))
    n = k.groupBy("kmer").agg(F.count(F.lit(1)).alias("n"))  # at most 4^6 rows
    return O.numbered(n, "kmer").select("kmer", "n", F.col("k").alias("place"))


@query("u09_concatenated", "SELECT name, count(*) AS n, min(key) AS first FROM (SELECT 'customer' AS name, c_custkey AS key FROM customer UNION ALL SELECT 'part', p_partkey FROM part UNION ALL SELECT 'supplier', s_suppkey FROM supplier) GROUP BY 1")
def u09(spark, sf_dir):
    one = lambda n, c: table(spark, sf_dir, n).select(F.lit(n).alias("name"), F.col(c).alias("key"))
    every = one("customer", "c_custkey").unionByName(one("part", "p_partkey")).unionByName(one("supplier", "s_suppkey"))
    return every.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first"))


@query(
    "u11_clade_difference",
    """WITH c AS (SELECT n_nationkey AS n, n_name AS name, n_regionkey AS x, CASE WHEN n_regionkey < 2 THEN n_regionkey ELSE n_nationkey % 3 + 2 END AS y FROM nation),
a AS (SELECT list_sort(list(name)) AS leaves FROM c GROUP BY x UNION ALL SELECT list_sort(list(name)) FROM c), b AS (SELECT list_sort(list(name)) AS leaves FROM c GROUP BY y UNION ALL SELECT list_sort(list(name)) FROM c)
SELECT 'left' AS side, array_to_string(leaves, ',') AS leaves FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'right', array_to_string(leaves, ',') FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
)
def u11(spark, sf_dir):
    n = table(spark, sf_dir, "nation")

    def tree(group):
        leaf = n.select(F.col("n_nationkey").cast("long").alias("node"), (group + 100).cast("long").alias("parent"), F.col("n_name").alias("name"), F.lit(1.0).alias("length"))
        inner = leaf.select(F.col("parent").alias("node")).distinct().select("node", F.lit(1000).cast("long").alias("parent"), F.lit(None).cast("string").alias("name"), F.lit(1.0).alias("length"))
        root = spark.range(1).select(F.lit(1000).cast("long").alias("node"), F.lit(None).cast("long").alias("parent"), F.lit(None).cast("string").alias("name"), F.lit(0.0).alias("length"))
        return leaf.union(inner).union(root)

    other = F.when(F.col("n_regionkey") < 2, F.col("n_regionkey")).otherwise(F.col("n_nationkey") % 3 + 2)
    return R.clade_difference(tree(F.col("n_regionkey")), tree(other)).select("side", F.array_join("leaves", ",").alias("leaves"))


@query("w06_qualifying_neighbours", f"{EDGES} SELECT feat, coalesce(lag(cluster) OVER w, CASE WHEN contig % 2 = 0 AND n > 1 THEN last_value(cluster) OVER v END) AS previous, coalesce(lead(cluster) OVER w, CASE WHEN contig % 2 = 0 AND n > 1 THEN first_value(cluster) OVER v END) AS next FROM nb WINDOW w AS (PARTITION BY contig ORDER BY pos), v AS (PARTITION BY contig ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)")
def w06(spark, sf_dir):
    f = features(spark, sf_dir)
    return O.circular_neighbours(O.qualifying(f, sizes(f), 8), F.col("contig") % 2 == 0, ["pos"]).select("feat", "previous", "next")


@query("x05_midpoints", f"WITH {INTERVALS} SELECT contig, kind, count(*) AS n, sum(stop - start + 1) AS bases, max((start + stop) / 2) AS last_midpoint, round(max(100.0::DOUBLE * (stop - start + 1) / 200), 6) AS percent FROM intervals GROUP BY 1, 2")
def x05(spark, sf_dir):
    n = F.col("stop") - F.col("start") + 1
    return intervals(spark, sf_dir).groupBy("contig", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum(n).alias("bases"), F.max((F.col("start") + F.col("stop")) / 2).alias("last_midpoint"), F.round(F.max(100.0 * n / 200), 6).alias("percent"))


def _bands(value: str, bands) -> str:
    return "CASE " + " ".join(f"WHEN {value} >= {least}::DOUBLE THEN {score}::DOUBLE" for least, score in bands) + " ELSE 0.0::DOUBLE END"


@query("x15_homology_score", f"SELECT l_orderkey, l_linenumber, l_partkey, round((l_partkey % 2) + (l_suppkey % 10) / 10 + 1 / l_linenumber + {_bands('(50 + l_quantity) / 100', S.IDENTITY_BANDS)} + {_bands('1 - l_discount * 6', S.LENGTH_BANDS)}, 9) AS score FROM lineitem")
def x15(spark, sf_dir):
    score = S.homology_score(50 + F.col("l_quantity"), 1 - F.col("l_discount") * 6, F.col("l_suppkey") % 10 / 10, F.col("l_linenumber"), F.col("l_partkey") % 2)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(score, 9).alias("score"))


@query("x16_buffered_length", "SELECT p_partkey, CAST(floor(CASE WHEN n < 50 THEN 2 * n + 1 WHEN n < 100 THEN 1.5::DOUBLE * n + 26 WHEN n < 1000 THEN 1.2::DOUBLE * n + 56 ELSE 1.1::DOUBLE * n + 156 END) AS BIGINT) AS buffered FROM (SELECT p_partkey, p_size * p_size AS n FROM part)")
def x16(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.buffered_length(F.col("p_size") * F.col("p_size")).alias("buffered"))


@query("x18_intron_phases", "WITH e AS (SELECT conv_id, turn, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS s, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations) SELECT conv_id, string_agg(CAST(s % 3 AS VARCHAR), ',' ORDER BY turn) AS phases FROM e WHERE back > 1 GROUP BY 1")
def x18(spark, sf_dir):
    t = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.length("text").alias("n")))).alias("e"))
    p = t.select("conv_id", S.intron_phases(F.transform("e", lambda x: x["n"])).alias("p")).where(F.size("p") > 0)
    return p.select("conv_id", F.array_join(F.transform("p", lambda x: x.cast("string")), ",").alias("phases"))


@query("x31_distance_weights", "SELECT least(l_linenumber, 5) AS d, CAST(sum(pow(3, 6 - least(l_linenumber, 5))) AS BIGINT) AS weight FROM lineitem GROUP BY 1")
def x31(spark, sf_dir):
    d = F.least(F.col("l_linenumber"), F.lit(5))
    return table(spark, sf_dir, "lineitem").groupBy(d.alias("d")).agg(F.sum(F.pow(F.lit(3.0), 6 - d)).cast("long").alias("weight"))


@query("x33_introduced_stops")
def x33(spark, sf_dir):
    """Stop codons where the longest sequence of the genome has open frames."""
    s = sequences(spark, sf_dir).where(F.length("seq") > 0)
    model = s.groupBy("genome").agg(F.max_by("seq", F.struct(F.length("seq"), -F.col("id"))).alias("model"))
    opens = model.select("genome", S.open_frames(F.col("model")).alias("o"))
    found = s.join(F.broadcast(opens), "genome").select("id", F.explode(S.introduced_stops(F.col("seq"), F.col("o"))).alias("f"))
    return found.select("id", "f.frame", "f.offset")
