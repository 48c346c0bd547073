"""Hit tables: scores of pairs of features, best matches and cut-offs.

A hit is (qid, sid, qgenome, sgenome, score, ...). Where reference behaviour depends on
the order of a file or a hash, ties here are broken by score, then ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def filter_hits(hits: DataFrame, min_pid: float = 35, max_evalue: float = 1e-5, factor: float = 10) -> DataFrame:
    """Hits of enough identity, dropping those whose e-value is above both the limit and factor times the query's best."""
    best = F.min("evalue").over(Window.partitionBy("qid"))
    weak = (F.col("evalue") > max_evalue) & (F.col("evalue") > factor * F.col("_best"))
    return hits.where(F.col("pid") >= min_pid).withColumn("_best", best).where(~weak).drop("_best")


def top_fraction(hits: DataFrame, fraction: float = 0.8, score: str = "bits") -> DataFrame:
    """Hits of at least the fraction of the best score for their query and subject genome."""
    best = F.max(score).over(Window.partitionBy("qid", "sgenome"))
    return hits.withColumn("_best", best).where(F.col(score) >= fraction * F.col("_best")).drop("_best")


def full_length(qlen: Column, slen: Column, qstart: Column, qend: Column, sstart: Column, send: Column, ends: int = 20, percent: float = 80) -> Column:
    """Whether a hit misses at most so much at each end of both, and covers enough of both."""
    missing = (qstart <= ends + 1) & (qlen - qend <= ends) & (sstart <= ends + 1) & (slen - send <= ends)
    return missing & ((qend - qstart + 1) * 100 >= percent * qlen) & ((send - sstart + 1) * 100 >= percent * slen)


def best_per_pair(hits: DataFrame, score: str = "bits") -> DataFrame:
    """qid, sid, qgenome, sgenome, score: the highest score of each pair."""
    return hits.groupBy("qid", "sid", "qgenome", "sgenome").agg(F.max(score).alias("score"))


def bounded(pairs: DataFrame) -> DataFrame:
    """Pairs with self hits added where missing (the highest score of the feature) and scores bounded by the query's self score."""
    own = pairs.where("qid = sid").select(F.col("qid").alias("id"), F.col("score").alias("own"))
    sides = pairs.select(F.explode(F.array(F.struct(F.col("qid").alias("id"), F.col("qgenome").alias("genome"), "score"), F.struct(F.col("sid").alias("id"), F.col("sgenome").alias("genome"), "score"))).alias("x")).select("x.*")
    top = sides.groupBy("id", "genome").agg(F.max("score").alias("top"))
    selfs = top.join(own, "id", "left").select("id", "genome", F.coalesce("own", "top").alias("self"))
    added = selfs.select(F.col("id").alias("qid"), F.col("id").alias("sid"), F.col("genome").alias("qgenome"), F.col("genome").alias("sgenome"), F.col("self").alias("score"))
    q = selfs.select(F.col("id").alias("qid"), F.col("self").alias("_self"))
    others = pairs.where("qid <> sid").join(q, "qid").select("qid", "sid", "qgenome", "sgenome", F.least("score", "_self").alias("score"))
    return others.unionByName(added)


def symmetric(pairs: DataFrame) -> DataFrame:
    """Pairs with the missing reverse of each added, bounded by the new query's self score."""
    back = pairs.where("qid <> sid").select(F.col("sid").alias("qid"), F.col("qid").alias("sid"), F.col("sgenome").alias("qgenome"), F.col("qgenome").alias("sgenome"), "score")
    own = pairs.where("qid = sid").select("qid", F.col("score").alias("_self"))
    missing = back.join(pairs, ["qid", "sid"], "left_anti").join(own, "qid")
    return pairs.unionByName(missing.select("qid", "sid", "qgenome", "sgenome", F.least("score", "_self").alias("score")))


def blast_score_ratio(pairs: DataFrame) -> DataFrame:
    """qid, sid, qgenome, sgenome, norm, bsr for symmetric, bounded pairs of different features.

    norm = score / self score of the query; bsr = mean of both directions.
    """
    own = pairs.where("qid = sid").select("qid", F.col("score").alias("_self"))
    n = pairs.where("qid <> sid").join(own, "qid").select("qid", "sid", "qgenome", "sgenome", (F.least("score", "_self") / F.col("_self")).alias("norm"))
    back = n.select(F.col("sid").alias("qid"), F.col("qid").alias("sid"), F.col("norm").alias("_back"))
    return n.join(back, ["qid", "sid"]).select("qid", "sid", "qgenome", "sgenome", "norm", ((F.col("norm") + F.col("_back")) / 2).alias("bsr"))


def score_ratios(pairs: DataFrame) -> DataFrame:
    """blast_score_ratio(symmetric(bounded(pairs))) in one aggregation of the pairs, both directions of a pair in one row.

    pairs: qid, sid, qgenome, sgenome, score, one row a direction; a feature has one genome.
    """
    sides = pairs.select("score", F.explode(F.array(F.struct(F.col("qid").alias("id"), (F.col("qid") == F.col("sid")).alias("own")), F.struct(F.col("sid").alias("id"), F.lit(False).alias("own")))).alias("x"))
    selfs = sides.groupBy("x.id").agg(F.coalesce(F.max(F.when(F.col("x.own"), F.col("score"))), F.max("score")).alias("self"))
    first = F.col("qid") < F.col("sid")
    pick = lambda c, value: F.max(F.when(c, F.col(value)))
    both = pairs.where("qid <> sid").groupBy(F.least("qid", "sid").alias("a"), F.greatest("qid", "sid").alias("b")).agg(
        pick(first, "score").alias("there"), pick(~first, "score").alias("back"), F.max(F.when(first, F.col("qgenome")).otherwise(F.col("sgenome"))).alias("ga"), F.max(F.when(first, F.col("sgenome")).otherwise(F.col("qgenome"))).alias("gb")
    )
    for c in ("a", "b"):
        both = both.join(selfs.select(F.col("id").alias(c), F.col("self").alias(f"s{c}")), c)
    there, back = F.least("there", "sa"), F.least("back", "sb")
    there, back = (F.when(F.col("there").isNull(), F.least(back, F.col("sa"))).otherwise(there), F.when(F.col("back").isNull(), F.least(there, F.col("sb"))).otherwise(back))
    both = both.withColumns({"na": there / F.col("sa"), "nb": back / F.col("sb")}).withColumn("bsr", (F.col("na") + F.col("nb")) / 2)
    row = lambda q, t: F.struct(F.col(q).alias("qid"), F.col(t).alias("sid"), F.col(f"g{q}").alias("qgenome"), F.col(f"g{t}").alias("sgenome"), F.col(f"n{q}").alias("norm"), "bsr")
    return both.select(F.explode(F.array(row("a", "b"), row("b", "a"))).alias("x")).select("x.*")


def best_match(bsr: DataFrame, strict: bool = True, share: float = 0.95, score: str = "bsr") -> DataFrame:
    """The best subject of each query in each other genome, if share x best > second (>= unless strict)."""
    w = Window.partitionBy("qid", "sgenome").orderBy(F.col(score).desc(), "sid")
    ranked = bsr.where("qgenome <> sgenome").withColumn("_rank", F.row_number().over(w)).withColumn("second", F.lead(score, 1, 0.0).over(w)).where("_rank = 1").drop("_rank")
    margin = share * F.col(score)
    return ranked.where(margin > F.col("second") if strict else margin >= F.col("second"))


def reciprocal(best: DataFrame) -> DataFrame:
    """qid, sid pairs that are best matches both ways. Both directions of a pair meet in one window, so best is evaluated once."""
    w = Window.partitionBy(F.least("qid", "sid"), F.greatest("qid", "sid"))
    both = best.where("qid is not null and sid is not null").withColumns({"_there": F.max(F.col("qid") <= F.col("sid")).over(w), "_back": F.max(F.col("qid") >= F.col("sid")).over(w)})
    return both.where("_there and _back").select(*best.columns)


def best_two(pairs: DataFrame) -> DataFrame:
    """qid, sgenome, best, second: the two highest scores of distinct subjects (second 0 where there is one)."""
    w = Window.partitionBy("qid", "sgenome").orderBy(F.col("score").desc(), "sid")
    r = pairs.withColumn("_rank", F.row_number().over(w)).where("_rank <= 2")
    return r.groupBy("qid", "sgenome").agg(F.max("score").alias("best"), F.max(F.when(F.col("_rank") == 2, F.col("score")).otherwise(0.0)).alias("second"))


def score_histogram(scores: DataFrame, score: str, bins: int = 101) -> DataFrame:
    """bin, n, share: floor(100 x score) for scores from 0 to 1, every bin there."""
    n = scores.groupBy(F.floor(F.col(score) * 100).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    all_bins = scores.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    full = all_bins.join(F.broadcast(n), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # 101 rows
    return full.withColumn("share", F.col("n") / total)


def cutoff(best: DataFrame, second: DataFrame, clamp: float = 0.95, weight: float = 3) -> DataFrame:
    """cutoff: where the sum from the top of (best - weight x second) over two histograms is largest, at most clamp.

    Without a positive sum the cut-off is clamp. The histograms have 101 rows.
    """
    d = best.select("bin", F.col("share").alias("b")).join(second.select("bin", F.col("share").alias("s")), "bin")
    w = Window.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    run = d.withColumn("gain", F.sum(F.col("b") - weight * F.col("s")).over(w))
    top = run.agg(F.max(F.struct(F.round("gain", 9).alias("gain"), "bin")).alias("t"))
    return top.select(F.least(F.when(F.col("t.gain") > 0, F.col("t.bin") / 100).otherwise(1.0), F.lit(clamp)).alias("cutoff"))


def best_cutoff(best: DataFrame, bins: int = 101) -> DataFrame:
    """The cutoff from the histograms of bsr and second of best matches, counted in one pass."""
    kinds = best.select(F.explode(F.array(F.struct(F.lit(True).alias("first"), F.col("bsr").alias("v")), F.struct(F.lit(False).alias("first"), F.col("second").alias("v")))).alias("x"))
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    n = kinds.groupBy(F.floor(F.col("x.v") * 100).cast("int").alias("bin")).agg(count(F.col("x.first")).alias("n1"), count(~F.col("x.first")).alias("n2"))
    full = best.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).join(n, "bin", "left").na.fill(0)
    share = lambda c: F.col(c) / F.sum(c).over(Window.partitionBy())  # noqa: E731  (one row a bin)
    shares = full.select("bin", share("n1").alias("s1"), share("n2").alias("s2"))
    return cutoff(shares.select("bin", F.col("s1").alias("share")), shares.select("bin", F.col("s2").alias("share")))


def relative_best(hits: DataFrame, top: int = 5, share: float = 0.95) -> DataFrame:
    """For each cluster (sid): hits that tie with its best, or are among the first `top` and above share x best."""
    w = Window.partitionBy("sid").orderBy(F.col("bits").desc(), F.col("pid").desc(), "qid")
    r = hits.withColumn("rank", F.row_number().over(w)).withColumn("best", F.first("bits").over(w))
    return r.where((F.col("bits") == F.col("best")) | ((F.col("rank") <= top) & (F.col("bits") > share * F.col("best")))).drop("best")


def half_of_best(hits: DataFrame, share: float = 0.5, min_pid: float = 90) -> DataFrame:
    """Per query: at least share x its top score, and enough identity."""
    return hits.withColumn("_top", F.max("bits").over(Window.partitionBy("qid"))).where((F.col("bits") >= share * F.col("_top")) & (F.col("pid") >= min_pid)).drop("_top")


def top_k(hits: DataFrame, k: int, score: str = "bits") -> DataFrame:
    """The k best subjects of each query."""
    w = Window.partitionBy("qid").orderBy(F.col(score).desc(), "sid")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def missing_features(hits: DataFrame, features: DataFrame) -> DataFrame:
    """id, state: features that are never a query, never a subject or neither."""
    q, s = hits.select(F.col("qid").alias("id"), F.lit(True).alias("q")).distinct(), hits.select(F.col("sid").alias("id"), F.lit(True).alias("s")).distinct()
    j = features.select("id").join(q, "id", "left").join(s, "id", "left").where("q is null or s is null")
    state = F.when(F.col("q").isNull() & F.col("s").isNull(), "neither").when(F.col("q").isNull(), "never a query").otherwise("never a subject")
    return j.select("id", state.alias("state"))


def medoids(bsr: DataFrame, members: DataFrame) -> DataFrame:
    """cluster, medoid, total: the member with the largest sum of scores to the others of its cluster; ties by id. members: id, cluster."""
    m = members.select(F.col("id").alias("qid"), "cluster")
    other = members.select(F.col("id").alias("sid"), F.col("cluster").alias("_c"))
    sums = bsr.join(m, "qid").join(other, "sid").where("cluster = _c").groupBy("cluster", "qid").agg(F.sum("bsr").alias("total"))
    sums = sums.withColumn("total", F.round("total", 9))
    top = sums.groupBy("cluster").agg(F.max(F.struct("total", (-F.col("qid")).alias("minus"))).alias("t"))
    return top.select("cluster", (-F.col("t.minus")).alias("medoid"), F.col("t.total").alias("total"))


def genome_identity(best: DataFrame) -> DataFrame:
    """g1, g2, identity: length-weighted mean identity of the pairs of two genomes, the mean of both directions."""
    one = best.groupBy(F.col("qgenome").alias("g1"), F.col("sgenome").alias("g2")).agg((F.sum(F.col("len") * F.col("pid")) / F.sum("len")).alias("x"))
    both = one.union(one.select("g2", "g1", "x"))
    return both.groupBy("g1", "g2").agg(F.avg("x").alias("identity"))


def paralog_weights(links: DataFrame, members: DataFrame) -> DataFrame:
    """c1, c2 (c1 < c2), n: unordered linked pairs between two clusters. links: qid, sid; members: id, cluster."""
    q, s = members.select(F.col("id").alias("qid"), F.col("cluster").alias("a")), members.select(F.col("id").alias("sid"), F.col("cluster").alias("b"))
    pair = links.select(F.least("qid", "sid").alias("qid"), F.greatest("qid", "sid").alias("sid")).distinct()
    j = pair.join(q, "qid").join(s, "sid").where("a <> b")
    return j.groupBy(F.least("a", "b").alias("c1"), F.greatest("a", "b").alias("c2")).agg(F.count(F.lit(1)).alias("n"))


def strict_ortholog(mode: str, r: dict[str, Column]) -> Column:
    """Whether a relationship counts in mode N (all), M (neighbours decide) or Y (neighbours, or strong scores)."""
    base = (r["qgenome"] != r["sgenome"]) & (r["bibest"] | r["synbibest"])
    if mode == "N":
        return base
    near = r["anchor"] | r["extend"] | (r["cgn"] > r["window"])
    return base & (near if mode == "M" else near | (r["above_cut"] & (r["bibest"] | (r["cgn"] > 1))))
