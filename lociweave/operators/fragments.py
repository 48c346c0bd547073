"""Genes in pieces: labels of fragments and fusions, groups of fragments, hits in padding, walks from anchors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import components, settle


def fragment_labels(matches: DataFrame, members: DataFrame, short: float = 0.9, long: float = 1.1) -> DataFrame:
    """feat, cluster, label of members that look like fragments or fusions.

    members: feat, cluster, length; matches: qid, sid, full (both sides nearly whole), one row a pair. A member shorter than its
    cluster's mean with few whole matches there is a fragment in the cluster; a longer one whose matches outside are
    all to shorter features a fusion; one with more matches outside than inside, all to shorter ones, a fragment out of it.
    """
    mean = members.groupBy("cluster").agg(F.avg("length").alias("mean"))
    m = members.join(mean, "cluster")
    q = m.select(F.col("feat").alias("qid"), "cluster", "length", "mean")
    s = m.select(F.col("feat").alias("sid"), F.col("cluster").alias("scluster"), F.col("length").alias("slength"))
    inside = F.col("cluster") == F.col("scluster")
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    got = matches.where("qid <> sid").join(q, "qid").join(s, "sid").groupBy("qid", "cluster", "length", "mean").agg(
        count(inside).alias("inside"),
        count(~inside).alias("outside"),
        count(inside & F.col("full")).alias("whole"),
        count(~inside & (F.col("slength") < F.col("length"))).alias("shorter"),
    )
    all_shorter = F.col("shorter") == F.col("outside")
    label = F.when((F.col("length") < short * F.col("mean")) & (2 * F.col("whole") < F.col("inside")), "fragment in cluster")
    fused = (F.col("length") > long * F.col("mean")) & (F.col("shorter") > F.col("whole")) & all_shorter
    label = label.when(fused & (F.col("shorter") + F.col("whole") + 1 >= F.col("inside")), "fusion")
    label = label.when((F.col("outside") > F.col("inside")) & all_shorter, "fragment out of cluster")
    return got.select(F.col("qid").alias("feat"), "cluster", label.alias("label")).where("label is not null")


def fragment_groups(hits: DataFrame, places: DataFrame, whole_matches: DataFrame, apart: int = 3, ratio: float = 1.33, at_least: int = 1, ends: int = 2) -> DataFrame:
    """feat, group, kept: features that queries hit as pieces of one; the longest of each group is kept.

    hits: qid, sid, start, stop (on the query); places: feat, contig, pos, length, and genome where contigs are parts of one; whole_matches: feat, n. Two rules
    link features. A query's only two hits in a genome, each among the `ends` first or last places of its contig, the same or two: one
    piece may go on where the contig ends. Else, of a query's hits on one contig, two that follow each other, at most `apart` positions away.
    Under both the lengths together must stay below ratio x their span on the query. A link needs at_least queries and half as many as either feature has whole matches.
    """
    if "genome" not in places.columns:
        places = places.withColumn("genome", F.col("contig"))
    reach = places.groupBy("contig").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
    at = places.join(reach, "contig").withColumn("at_end", (F.col("pos") - F.col("first") < ends) | (F.col("last") - F.col("pos") < ends))
    h = hits.join(at.select(F.col("feat").alias("sid"), "contig", "pos", "genome", "at_end"), "sid")
    one = F.struct("sid", "start", "stop")
    two = h.groupBy("qid", "genome").agg(F.count(F.lit(1)).alias("n"), F.min(one).alias("x"), F.max(one).alias("y"), F.min("at_end").alias("at_ends")).where("n = 2 and at_ends")
    fits = lambda a0, a1, b0, b1: F.col(a1) - F.col(a0) + F.col(b1) - F.col(b0) + 2 < ratio * (F.greatest(a1, b1) - F.least(a0, b0) + 1)
    over = two.where(fits("x.start", "x.stop", "y.start", "y.stop")).select(F.col("x.sid").alias("a"), F.col("y.sid").alias("b"), "qid")
    w = Window.partitionBy("qid", "contig").orderBy("pos", "sid")
    before = lambda c: F.lag(c).over(w)
    inside = h.join(two.select("qid", "genome"), ["qid", "genome"], "left_anti")
    pair = inside.select("qid", "start", "stop", "pos", F.col("sid").alias("b"), *(before(c).alias(n) for c, n in (("sid", "a"), ("start", "start0"), ("stop", "stop0"), ("pos", "pos0"))))
    near = pair.where((F.col("pos") - F.col("pos0")).between(1, apart) & fits("start0", "stop0", "start", "stop"))
    near = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "qid").union(over)
    links = near.groupBy("a", "b").agg(F.countDistinct("qid").alias("weight")).where(F.col("weight") >= at_least)
    for side in ("a", "b"):
        n = whole_matches.select(F.col("feat").alias(side), "n")
        links = links.join(n, side, "left").where(2 * F.col("weight") >= F.coalesce("n", F.lit(0))).drop("n")
    later = components(links.select("a", "b"))  # all but the smallest feature of each group
    groups = later.union(later.select("component", "component").distinct()).toDF("feat", "group")
    first = Window.partitionBy("group").orderBy(F.col("length").desc(), "feat")
    return groups.join(places.select("feat", "length"), "feat").select("feat", "group", (F.row_number().over(first) == 1).alias("kept"))


def outside_padding(hits: DataFrame, contigs: DataFrame) -> DataFrame:
    """The hits without those that lie wholly in the padding of a circular contig. contigs: sid, length, padding, circular."""
    c = contigs.select("sid", F.col("padding").alias("_p"), F.col("length").alias("_n"), F.col("circular").alias("_c"))
    low, high = F.least("sstart", "send"), F.greatest("sstart", "send")
    padded = F.coalesce(F.col("_c") & ((high <= F.col("_p")) | (low > F.col("_p") + F.col("_n"))), F.lit(False))
    return hits.join(c, "sid", "left").where(~padded).select(*hits.columns)


#: Places tried from a relation, in turn, as (steps on the query, steps on the subject).
WALK_STEPS = ((1, 1), (2, 1), (3, 1), (1, 2), (2, 2))


def extended_anchors(relations: DataFrame, places: DataFrame, anchor: Column, max_rounds: int = 64) -> DataFrame:
    """qid, sid, anchor, extended: relations that walks from the anchors meet, both ways along the query's contig.

    relations: qid, sid (each pair once) and what anchor needs; places: id, contig, pos without gaps, orient. A walk goes to the first
    place of WALK_STEPS that holds a relation: an extended one, from which it goes on, or an anchor, where it ends. It takes the
    subject's contig along or against, as the strands of the anchor's pair agree or not. Two steps on the subject are tried only where the
    query's contig has three more features. Each relation has at most one next one a way, so joins of doubling reach
    find all walks in as many rounds as the logarithm of the longest.
    """
    side = lambda k: places.select(F.col("id").alias(f"{k}id"), F.col("contig").alias(f"{k}c"), F.col("pos").alias(f"{k}p"), F.col("orient").alias(f"{k}o"))
    bounds = places.groupBy(F.col("contig").alias("qc")).agg(F.min("pos").alias("low"), F.max("pos").alias("high"))
    at = relations.withColumn("anchor", anchor).join(side("q"), "qid").join(side("s"), "sid").join(bounds, "qc")
    at = settle(at.select("qid", "sid", "anchor", "qc", "sc", "qp", "sp", (F.col("qo") * F.col("so")).alias("own"), "low", "high"), merge=True)
    tries = [F.struct(F.lit(r).alias("r"), F.lit(d).alias("d"), F.lit(t).alias("t"), F.lit(a).alias("a"), F.lit(b).alias("b")) for d in (1, -1) for t in (1, -1) for r, (a, b) in enumerate(WALK_STEPS)]
    ask = at.select("qid", "sid", "qc", "sc", "qp", "sp", "low", "high", F.explode(F.array(*tries)).alias("x")).select("*", "x.*").where("b = 1 or qp + 3 * d between low and high")
    ask = ask.select(F.struct("qid", "sid", "d", "t").alias("state"), "r", "qc", "sc", (F.col("qp") + F.col("d") * F.col("a")).alias("qp"), (F.col("sp") + F.col("d") * F.col("t") * F.col("b")).alias("sp"))
    met = ask.join(at.select("qc", "sc", "qp", "sp", "qid", "sid", "anchor"), ["qc", "sc", "qp", "sp"])
    first = met.groupBy("state").agg(F.min(F.struct("r", "qid", "sid", "anchor")).alias("m")).where("not m.anchor")
    jump = settle(first.select("state", F.struct("m.qid", "m.sid", "state.d", "state.t").alias("to")), merge=True)
    reached = at.where("anchor").select(F.explode(F.array(*(F.struct("qid", "sid", F.lit(d).alias("d"), F.col("own").alias("t")) for d in (1, -1)))).alias("state"))
    for _ in range(max_rounds):
        if jump.isEmpty():
            break
        reached = settle(reached.union(reached.join(jump, "state").select("to")).distinct(), merge=True)
        jump = settle(jump.join(jump.toDF("to", "further"), "to").select("state", "further"), merge=True).toDF("state", "to")
    else:
        raise RuntimeError("walks did not end")
    got = reached.select("state.qid", "state.sid").distinct().withColumn("_met", F.lit(True))
    return at.join(got, ["qid", "sid"], "left").select("qid", "sid", "anchor", (F.col("_met").isNotNull() & ~F.col("anchor")).alias("extended"))


def paralog_penalty(methods: DataFrame, scores: DataFrame) -> DataFrame:
    """a, b, penalty, genes: for two clustering methods, the mean over genes that both place of the mean score of members that only one of them puts with the gene.

    methods: method, cluster, gene; scores: qid, sid, score. Genes without a score to themselves are left out.
    """
    scored = scores.where("qid = sid").select(F.col("qid").alias("gene"))
    own = methods.join(scored, "gene", "left_semi")
    mate = methods.select("method", "cluster", F.col("gene").alias("sid"))
    score = scores.groupBy(F.col("qid").alias("gene"), "sid").agg(F.max("score").alias("score"))
    near = own.join(score, "gene").join(mate, ["method", "cluster", "sid"])
    near = near.groupBy("gene", "method").agg(F.collect_list(F.struct("sid", "score")).alias("mates"))
    each = own.select("gene", "method").distinct().join(near, ["gene", "method"], "left")
    each = each.select("gene", "method", F.coalesce("mates", F.array().cast(near.schema["mates"].dataType)).alias("mates"))
    a = each.select("gene", F.col("method").alias("a"), F.col("mates").alias("ma"))
    b = each.select("gene", F.col("method").alias("b"), F.col("mates").alias("mb"))

    def mean_of(x: str, y: str) -> Column:
        only = F.array_except(x, y)
        total = F.aggregate(only, F.lit(0.0), lambda t, m: t + m["score"])
        return F.when(F.size(only) > 0, total / F.size(only)).otherwise(0.0)

    both = a.join(b, "gene").select("a", "b", ((mean_of("ma", "mb") + mean_of("mb", "ma")) / 2).alias("p"))
    return both.groupBy("a", "b").agg(F.avg("p").alias("penalty"), F.count(F.lit(1)).alias("genes"))


def consensus_lines(chains: DataFrame) -> DataFrame:
    """chain, length, line: the nodes of each chain in order, with commas between; the longest chain bounds a row."""
    placed = chains.groupBy("chain").agg(F.array_sort(F.collect_list(F.struct("place", "node"))).alias("p"))
    return placed.select("chain", F.size("p").alias("length"), F.array_join(F.transform("p", lambda x: x["node"].cast("string")), ",").alias("line"))
