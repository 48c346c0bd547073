"""Queries over graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as G
from ..operators import hits as H
from .hits import BEST, ratios
from .registry import query
from .standin import MEMBERS, members, table

LINKS = "links AS (SELECT DISTINCT o_custkey AS a, 10000000 + l_partkey AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def links(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("a"), (F.lit(10000000) + F.col("l_partkey")).alias("b")).distinct()


CC = f"""WITH RECURSIVE {LINKS}, e AS (SELECT a, b FROM links UNION SELECT b, a FROM links), c(node, component) USING KEY (node) AS (SELECT DISTINCT a, a FROM e
 UNION (SELECT e.b, min(c.component) FROM c JOIN e ON e.a = c.node JOIN recurring.c AS r ON r.node = e.b WHERE c.component < r.component GROUP BY e.b))"""


@query("g01_components", f"{CC} SELECT node, component FROM c WHERE node <> component")
def g01(spark, sf_dir):
    return G.components(links(spark, sf_dir))


@query("g02_greedy_clusters")
def g02(spark, sf_dir):
    m = H.reciprocal(H.best_match(ratios(spark, sf_dir)))
    e = m.where("qid < sid").select(F.col("qid").alias("a"), F.col("sid").alias("b"), F.col("qgenome").alias("ga"), F.col("sgenome").alias("gb"), F.col("bsr").alias("score"))
    return G.greedy_clusters(e)


@query("g03_top_cliques", f"""{BEST}, rbh AS (SELECT a.qid, a.sid FROM best a JOIN best b ON a.qid = b.sid AND a.sid = b.qid), own AS (SELECT qid, list_sort(list_distinct(list_append(list(sid), qid))) AS m FROM rbh GROUP BY qid HAVING len(list_distinct(list_append(list(sid), qid))) >= 3),
x AS (SELECT qid, m, unnest(m) AS o FROM own) SELECT x.qid, len(any_value(x.m)) AS size FROM x JOIN own y ON y.qid = x.o AND y.m = x.m GROUP BY x.qid HAVING count(*) = len(any_value(x.m))""")
def g03(spark, sf_dir):
    return G.top_cliques(H.reciprocal(H.best_match(ratios(spark, sf_dir))).select("qid", "sid"))


@query(
    "g03_whole_cliques",
    """WITH m AS (SELECT a.p_partkey AS qid, b.p_partkey AS sid, -abs(a.p_retailprice - b.p_retailprice) AS score FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size % 10 = b.p_size % 10 WHERE a.p_partkey <> b.p_partkey),
bar AS (SELECT qid, max(score) FILTER (score < -60) AS bar, count(*) AS n FROM m GROUP BY 1), own AS (SELECT qid, n, list_sort(list_append(list(sid), qid)) AS s FROM m JOIN bar USING (qid) WHERE score >= -60 AND (bar IS NULL OR score >= bar) GROUP BY qid, n HAVING count(*) >= 2),
x AS (SELECT qid, s, unnest(s) AS o FROM own), ok AS (SELECT x.qid, count(*) AS top, max(y.n) AS most FROM x JOIN own y ON y.qid = x.o AND y.s = x.s GROUP BY x.qid, x.s HAVING count(*) = len(x.s)) SELECT qid, coalesce(top, 0) AS top, CASE WHEN most = top - 1 THEN top ELSE 0 END AS whole FROM bar LEFT JOIN ok USING (qid)""",
)
def g03w(spark, sf_dir):
    """Parts of a brand and a class of sizes match each other, the nearer in price the better; mutual within 60. Parts of one price are a class of nodes."""
    cls = F.struct("p_brand", (F.col("p_size") % 10).alias("c"), F.col("p_retailprice").alias("price"))
    p = table(spark, sf_dir, "part").where("p_brand is not null and p_size is not null").select(F.col("p_partkey").alias("node"), cls.alias("class"))
    side = lambda k: p.select(F.col("class").alias(f"{k}id"), "class.p_brand", "class.c", F.col("class.price").alias(f"{k}price")).distinct()
    m = side("q").join(side("s"), ["p_brand", "c"]).select("qid", "sid", (-F.abs(F.col("qprice") - F.col("sprice"))).alias("score"))
    return G.cliques(m.withColumn("mutual", F.col("score") >= -60), p)


@query("g05_chains")
def g05c(spark, sf_dir):
    from ..operators import order as O
    from .order import best

    m = O.mutual_edges(best(spark, sf_dir)).where("c1 <> c2")
    node = lambda c: F.crc32(F.col(c).cast("binary"))
    return G.chains(m.select(node("c1").alias("a"), node("c2").alias("b")).distinct())


@query("g08_representatives")
def g08(spark, sf_dir):
    p = G.settle(links(spark, sf_dir))
    order = p.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("rank", F.col("node"))
    return G.greedy_representatives(p, order)


@query("t05_linkage_medoids", f"""{CC}, d AS (SELECT a, b, (a + b) % 97 / 97.0::DOUBLE AS distance FROM links), both_ AS (SELECT * FROM d UNION ALL SELECT b, a, distance FROM d), g AS (SELECT node, component FROM c),
s AS (SELECT g.component, x.a, round(sum(distance), 9) AS d, count(*) AS n FROM both_ x JOIN g ON g.node = x.a JOIN g h ON h.node = x.b AND h.component = g.component GROUP BY 1, 2) SELECT component, a AS medoid FROM (SELECT *, row_number() OVER (PARTITION BY component ORDER BY n DESC, d, a) AS r FROM s) WHERE r = 1""")
def t05(spark, sf_dir):
    p = links(spark, sf_dir)
    c = G.components(p)
    groups = c.union(c.select(F.col("component").alias("node"), "component").distinct())
    return G.linkage_medoids(p.withColumn("distance", (F.col("a") + F.col("b")) % 97 / F.lit(97.0)), groups)


@query("g14_property_states", """WITH RECURSIVE steps AS (SELECT DISTINCT p_size % 30 AS prop, CAST(substr(p_brand, 7) AS INTEGER) % 7 AS step FROM part), found AS (SELECT DISTINCT length(p_name) % 37 AS query FROM part),
hit AS (SELECT DISTINCT prop, step FROM steps WHERE (prop * 7 + step) % 37 IN (SELECT query FROM found) AND step % 2 = 0), ask AS (SELECT prop, step, prop + step AS needs FROM steps WHERE step % 2 = 1 AND prop + step < 30),
ok(prop, step) AS (SELECT prop, step FROM hit UNION SELECT a.prop, a.step FROM ask a JOIN ok o ON o.prop = a.needs), n AS (SELECT s.prop, count(o.step) AS n, count(*) FILTER (s.step < 2 AND o.step IS NULL) AS lacking FROM steps s LEFT JOIN (SELECT DISTINCT prop, step FROM ok) o ON s.prop = o.prop AND s.step = o.step GROUP BY 1)
SELECT prop, CASE WHEN n = 0 THEN 'NO' WHEN lacking > 0 THEN 'PARTIAL' ELSE 'YES' END AS state FROM n""")
def g14(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    s = p.select((F.col("p_size") % 30).alias("prop"), (F.expr("cast(substr(p_brand, 7) as int)") % 7).alias("step")).distinct().withColumn("required", F.col("step") < 2)
    found = p.select((F.length("p_name") % 37).cast("long").alias("query")).distinct()
    hit = s.where("step % 2 = 0").select("prop", "step", F.lit("hit").alias("kind"), ((F.col("prop") * 7 + F.col("step")) % 37).cast("long").alias("query"))
    ask = s.where("step % 2 = 1 and prop + step < 30").select("prop", "step", F.lit("prop").alias("kind"), (F.col("prop") + F.col("step")).cast("long").alias("query"))
    return G.property_states(s, hit.union(ask), found)


@query("j21_expand_hierarchy", f"WITH {MEMBERS} SELECT DISTINCT n_regionkey AS root, 'c' || cluster AS leaf FROM members JOIN nation ON genome = n_nationkey")
def j21(spark, sf_dir):
    m = members(spark, sf_dir)
    n = table(spark, sf_dir, "nation")
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    parts = n.select(name("r", "n_regionkey").alias("ref"), name("n", "n_nationkey").alias("part")).union(m.select(name("n", "genome"), name("c", "cluster")))
    top = n.select(F.col("n_regionkey").alias("root"), name("r", "n_regionkey").alias("ref")).distinct()
    return G.expand(top, parts)
