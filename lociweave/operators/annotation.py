"""Annotation roll-ups: mapping hits to terms, classes of hits, calls from flanks, allele categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def map_hits(hits: DataFrame, mapping: DataFrame, max_evalue: float) -> DataFrame:
    """Hits with the terms of their subject; subjects without any keep a null term. mapping: sid, term."""
    return hits.where(F.col("evalue") <= max_evalue).join(mapping, "sid", "left")


def first_match_terms(hits: DataFrame, mapping: DataFrame) -> DataFrame:
    """qid, sid, term: terms of each query's best subject that has any. mapping: sid, term."""
    has = hits.join(mapping.select("sid").distinct(), "sid", "left_semi")
    w = Window.partitionBy("qid").orderBy(F.col("bits").desc(), "sid")
    first = has.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("qid", "sid")
    return first.join(mapping, "sid").select("qid", "sid", "term").distinct()


def aspects(terms: DataFrame, table: DataFrame) -> DataFrame:
    """Exploded terms (id, terms array) with their aspect; terms that the table lacks are dropped."""
    return terms.select("id", F.explode("terms").alias("term")).join(table, "term")


def slim_category(terms: DataFrame) -> DataFrame:
    """id, category: of the last term in order that has one. terms: id, place, category."""
    return terms.where("category is not null").groupBy("id").agg(F.max_by("category", "place").alias("category"))


def hit_class(pid: Column, length: Column, full: Column, bits: Column, cutoff: Column) -> Column:
    """Perfect: identical over the whole length; Strict: at least the model's bit score; else Loose."""
    return F.when((pid >= 100) & (length == full), "Perfect").when(bits >= cutoff, "Strict").otherwise("Loose")


def best_class_only(hits: DataFrame) -> DataFrame:
    """Hits of the best class that their query has."""
    rank = F.when(F.col("class") == "Perfect", 1).when(F.col("class") == "Strict", 2).otherwise(3)
    return hits.withColumn("_r", rank).withColumn("_b", F.min("_r").over(Window.partitionBy("qid"))).where("_r = _b").drop("_r", "_b")


def improving_hit(hits: DataFrame) -> DataFrame:
    """qid, sid, bits, pid: walking hits by sid, each that improves both bit score and identity replaces the one held.

    Not a total order, so a fold over each query's sorted hits.
    """
    lists = hits.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("sid", F.col("bits").cast("double").alias("bits"), F.col("pid").cast("double").alias("pid")))).alias("h"))
    first = F.get("h", F.lit(0))
    won = F.aggregate(F.slice("h", 2, F.greatest(F.size("h") - 1, F.lit(0))), first, lambda s, x: F.when((x["bits"] > s["bits"]) & (x["pid"] > s["pid"]), x).otherwise(s))
    return lists.select("qid", won.alias("w")).select("qid", "w.sid", "w.bits", "w.pid")


def flank_calls(flanks: DataFrame, identity: float = 98, gap: int = 10, most: int = 200_000) -> DataFrame:
    """query, call from the best hits of a query: MUTATION, DELETION, TANDEM_DUPLICATION, INSERTION or PARTIAL.

    flanks: query, full_pid (null without a full hit), q5, q3 (inner query ends of the flanks, null without), s5, s3 (inner subject ends).
    """
    query_gap, subject_gap = F.col("q3") - F.col("q5") - 1, F.col("s3") - F.col("s5") - 1
    call = F.when(F.col("full_pid").isNotNull(), F.when(F.col("full_pid") < identity, "MUTATION"))
    call = call.when(F.col("q5").isNull() & F.col("q3").isNull(), None).when(F.col("q5").isNull() | F.col("q3").isNull(), "PARTIAL")
    call = call.when(F.greatest(F.abs(query_gap), F.abs(subject_gap)) > most, None).when(query_gap > gap, "INSERTION")
    call = call.when(subject_gap < 0, "TANDEM_DUPLICATION").when(subject_gap > 0, "DELETION")
    return flanks.select("query", call.alias("call"))


def length_stats(members: DataFrame) -> DataFrame:
    """cluster, n, least, most, mean, sd, median, q1, q3 of the lengths. members: cluster, length.

    Quartiles are the int((n + 1) / 4)-th values from either end; the median stands for them below four members.
    """
    g = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.min("length").alias("least"), F.max("length").alias("most"), F.avg("length").alias("mean"), F.coalesce(F.stddev_samp("length"), F.lit(0.0)).alias("sd"), F.array_sort(F.collect_list("length")).alias("v"))
    at = lambda k: F.element_at("v", k.cast("int"))
    half = F.floor(F.col("n") / 2)
    median = F.when(F.col("n") % 2 == 1, at(half + 1).cast("double")).otherwise((at(F.greatest(half, F.lit(1))) + at(half + 1)) / 2)
    g = g.withColumn("median", median)
    k = F.greatest(F.floor((F.col("n") + 1) / 4), F.lit(1))
    few = F.col("n") < 4
    return g.select("cluster", "n", "least", "most", "mean", "sd", "median", F.when(few, F.col("median")).otherwise(at(k)).alias("q1"), F.when(few, F.col("median")).otherwise(at(F.col("n") - k + 1)).alias("q3"))


def allele_category(length: Column, copies: Column, gapped: Column, stats: dict[str, Column]) -> Column:
    """Category of a genome's member against the length stats of its cluster."""
    tenth = 0.1 * stats["median"]
    return (
        F.when(gapped, "gapped")
        .when(length < stats["q1"] - tenth, "very_short")
        .when(length < stats["q1"] - 0.02 * stats["median"], "short")
        .when(length > stats["q3"] + tenth, "very_long")
        .when(length > stats["q3"] + 0.02 * stats["median"], "long")
        .when(copies == 1, "unique")
        .otherwise("identical")
    )


def best_references(distances: DataFrame, tiers: tuple[float, float] = (97, 94), gap: float = 0.5) -> DataFrame:
    """genome, best, best_ani, second_ani, level: the best reference and how sure it is. distances: genome, reference, ani; one row for each reference name."""
    w = Window.partitionBy("genome").orderBy(F.col("ani").desc(), "reference")
    r = distances.groupBy("genome", "reference").agg(F.max("ani").alias("ani")).withColumn("r", F.row_number().over(w)).withColumn("second_ani", F.lead("ani").over(w)).where("r = 1")
    sure = F.col("ani") - F.coalesce("second_ani", F.lit(0.0)) >= gap
    level = F.when((F.col("ani") >= tiers[0]) & sure, "species").when(F.col("ani") >= tiers[0], "ambiguous").when(F.col("ani") >= tiers[1], "genus").otherwise("none")
    return r.select("genome", F.col("reference").alias("best"), F.col("ani").alias("best_ani"), "second_ani", level.alias("level"))
