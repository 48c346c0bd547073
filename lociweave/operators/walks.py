"""Walks over oriented edges that carry the set of genomes which have every edge so far."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import settle


def bit_words(edges: DataFrame, genomes: DataFrame) -> DataFrame:
    """a, b, word, bits: oriented edges, both ways, with the genomes that have them as bits of longs, a row for each long that isn't 0.

    edges: c1, e1, c2, e2, genome; genomes: genome, number (from 0). a and b are ends, structs of cluster and end.
    """
    end = lambda c, e: F.struct(F.col(c).alias("cluster"), F.col(e).cast("int").alias("end"))
    e = edges.join(genomes, "genome").select(end("c1", "e1").alias("a"), end("c2", "e2").alias("b"), "number")
    e = e.union(e.select("b", "a", "number"))
    return e.groupBy("a", "b", F.floor(F.col("number") / 64).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, number % 64)")).alias("bits"))


def bit_vectors(edges: DataFrame, genomes: DataFrame) -> DataFrame:
    """a, b, vector: the same with all longs of an edge as an array; it grows with edges times genomes, so bit_words is for many genomes."""
    last = genomes.agg(F.max("number")).first()[0]
    return bit_words(edges, genomes).groupBy("a", "b").agg(F.collect_list(F.struct("word", "bits")).alias("w")).select("a", "b", _filled("w", (last or 0) // 64).alias("vector"))


def _filled(words: str, last: int) -> Column:
    m = F.map_from_entries(words)
    return F.transform(F.sequence(F.lit(0), F.lit(last)), lambda k: F.coalesce(m[k], F.lit(0).cast("long")))


def walks(starts: DataFrame, vectors: DataFrame, core: DataFrame, depth: int) -> DataFrame:
    """id, path, reason, steps, n, vector: every walk from a start along edges, with the genomes that have all of its edges and don't go on.

    starts: id, at (an end), stop (a cluster or null); vectors: a, b, vector, or a, b, word, bits; core: cluster. A walk leaves a cluster by an end and enters the next one by
    an end that it leaves by the other. Reasons: `stop` at the start's stop cluster, `core` at another core cluster, `end` where no edge goes on,
    `left` for genomes that have none of the edges that go on, `depth` for what the limit of clusters cuts; the limit counts clusters after the
    first. All walks of a length go on at once: a row of the front is a walk and one long of its genomes, and each round joins it with the edges that have some of
    the same long, ands the two and drops what no genome has; so a round grows with genomes and their edges, not with all edges of an end. The front is
    written each round. Clusters are written with + if left by their 3 end.
    """
    if "vector" in vectors.columns:
        vectors = vectors.select("a", "b", F.posexplode("vector").alias("word", "bits"))
    words = settle(vectors)
    last = words.agg(F.max("word")).first()[0]
    words = words.where("bits <> 0")
    onward = settle(words.groupBy("a", "word").agg(F.bit_or("bits").alias("any")))
    goes_on = onward.select(F.col("a").alias("at"), F.lit(True).alias("on")).distinct()
    everyone = onward.groupBy("word").agg(F.bit_or("any").alias("bits"))
    if last is None:
        everyone = everyone.sparkSession.range(1).select(F.lit(0).alias("word"), F.col("id").alias("bits"))
    is_core = core.select("cluster", F.lit(True).alias("is_core")).distinct()
    name = lambda x: F.concat(x["cluster"].cast("string"), F.when(x["end"] == 3, "+").otherwise("-"))
    front = settle(starts.select("id", "stop", "at", name(F.col("at")).alias("path"), F.lit(1).alias("steps")).crossJoin(F.broadcast(everyone)))  # a long for 64 genomes
    out = []
    for step in range(1, depth + 2):
        seen = front.join(is_core.select(F.col("cluster").alias("_c"), "is_core"), F.col("at.cluster") == F.col("_c"), "left").join(goes_on, "at", "left")
        reason = F.when(F.col("at.cluster") == F.col("stop"), "stop").when(F.col("is_core"), "core") if step > 1 else F.when(F.lit(False), "")
        reason = reason.when(F.col("on").isNull(), "end").when(F.lit(step > depth), "depth")
        seen = seen.select(*front.columns, reason.alias("reason"))
        open_ = seen.where("reason is null").drop("reason")
        rest = open_.join(onward.withColumnRenamed("a", "at"), ["at", "word"], "left").withColumn("bits", F.expr("bits & ~coalesce(any, 0L)")).where("bits <> 0")
        out.append(seen.where("reason is not null").unionByName(rest.select(*front.columns, F.lit("left").alias("reason"))))
        if step > depth:
            break
        moved = open_.join(words.select(F.col("a").alias("at"), "b", "word", F.col("bits").alias("has")), ["at", "word"]).withColumn("bits", F.expr("bits & has")).where("bits <> 0")
        at = F.struct(F.col("b.cluster").alias("cluster"), (8 - F.col("b.end")).cast("int").alias("end"))
        front = settle(moved.select("id", "stop", at.alias("at"), F.concat_ws(":", "path", name(at)).alias("path"), (F.col("steps") + 1).alias("steps"), "word", "bits"))
        if front.isEmpty():
            break
    ended = reduce(DataFrame.unionByName, out).groupBy("id", "stop", "at", "path", "reason", "steps")
    ended = ended.agg(F.sum(F.bit_count("bits")).cast("int").alias("n"), F.collect_list(F.struct("word", "bits")).alias("w"))
    return ended.select("id", "path", "reason", "steps", "n", _filled("w", last or 0).alias("vector"))
