"""Cluster membership: presence and absence of clusters in genomes.

Members are rows (cluster, genome), distinct. Every operator is a composition of
aggregations whose partial sums shrink the rows before each shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .order import numbered


def sizes(members: DataFrame) -> DataFrame:
    """cluster, n_genomes."""
    return members.groupBy("cluster").agg(F.countDistinct("genome").alias("n_genomes"))


def classify(members: DataFrame, n_genomes: int | Column, core_percent: float = 95) -> DataFrame:
    """cluster, n_genomes, is_core, is_shared, is_singleton; core is a subset of shared."""
    s = sizes(members)
    total = n_genomes if isinstance(n_genomes, Column) else F.lit(n_genomes)
    return s.select(
        "cluster",
        "n_genomes",
        (F.col("n_genomes") * 100 >= total * core_percent).alias("is_core"),
        (F.col("n_genomes") > 1).alias("is_shared"),
        (F.col("n_genomes") == 1).alias("is_singleton"),
    )


def category_totals(classified: DataFrame) -> DataFrame:
    """category, clusters, loci: overlapping categories, the total is shared plus singleton."""
    kinds = F.explode(
        F.array(
            *(
                F.struct(F.lit(n).alias("category"), c.alias("hit"))
                for n, c in (("core", F.col("is_core")), ("shared", F.col("is_shared")), ("singleton", F.col("is_singleton")), ("total", F.lit(True)))
            )
        )
    )
    e = classified.select("n_genomes", kinds.alias("k")).where("k.hit")
    return e.groupBy(F.col("k.category").alias("category")).agg(F.count(F.lit(1)).alias("clusters"), F.sum("n_genomes").alias("loci"))


def exclusive_categories(members: DataFrame, n_genomes: int, core_percent: float = 95) -> DataFrame:
    """category, clusters with core, shared and size-one apart from each other."""
    kind = F.when(F.col("n_genomes") * 100 >= n_genomes * core_percent, "core").when(F.col("n_genomes") > 1, "shared").otherwise("single")
    return sizes(members).groupBy(kind.alias("category")).agg(F.count(F.lit(1)).alias("clusters"))


def size_breakdown(members: DataFrame) -> DataFrame:
    """n_genomes, clusters."""
    return sizes(members).groupBy("n_genomes").agg(F.count(F.lit(1)).alias("clusters"))


def size_histogram(members: DataFrame) -> DataFrame:
    """genome, n_genomes, clusters: sizes of the clusters that each genome takes part in."""
    return members.join(sizes(members), "cluster").groupBy("genome", "n_genomes").agg(F.count(F.lit(1)).alias("clusters"))


def size_thresholds(members: DataFrame, at_least: int, at_most: int) -> DataFrame:
    """genome, n_large, n_small: its clusters of at least or at most so many genomes."""
    h = size_histogram(members)
    part = lambda c: F.sum(F.when(c, F.col("clusters")).otherwise(0))
    return h.groupBy("genome").agg(part(F.col("n_genomes") >= at_least).alias("n_large"), part(F.col("n_genomes") <= at_most).alias("n_small"))


def pairwise_shared(members: DataFrame) -> DataFrame:
    """g1, g2 (g1 < g2), shared, jaccard and sorensen in percent.

    Each genome of a cluster is a row before it meets the later ones, so a row holds at most one genome's pairs; they are added up in each task.
    Few clusters with many genomes are few bytes but many pairs, so the number of tasks is set, not left to the size of the shuffle.
    """
    per = members.groupBy("genome").agg(F.count(F.lit(1)).alias("n"))
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    gs = members.repartition(tasks, "cluster").groupBy("cluster").agg(F.sort_array(F.collect_set("genome")).alias("gs"))
    left = gs.select(F.explode("gs").alias("g1"), "gs")
    shared = left.select("g1", F.explode(F.filter("gs", lambda y: y > F.col("g1"))).alias("g2")).groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("shared"))
    out = shared.join(per.select(F.col("genome").alias("g1"), F.col("n").alias("n1")), "g1").join(per.select(F.col("genome").alias("g2"), F.col("n").alias("n2")), "g2")
    return out.select("g1", "g2", "shared", (F.col("shared") * 100 / (F.col("n1") + F.col("n2") - F.col("shared"))).alias("jaccard"), (F.col("shared") * 200 / (F.col("n1") + F.col("n2"))).alias("sorensen"))


def shared_with(members: DataFrame, few: DataFrame) -> DataFrame:
    """g1, g2, jaccard in percent, of a few genomes g1 (column a of few) and every other one that shares a cluster; members without repeats. As pairwise_shared has it, without all pairs."""
    per = members.groupBy("genome").agg(F.count(F.lit(1)).alias("n"))
    own = members.join(F.broadcast(few.select(F.col("a").alias("genome"))), "genome").select("cluster", F.col("genome").alias("g1"))
    shared = members.join(F.broadcast(own), "cluster").where("genome <> g1").groupBy("g1", F.col("genome").alias("g2")).agg(F.count(F.lit(1)).alias("shared"))
    out = shared.join(per.select(F.col("genome").alias("g1"), F.col("n").alias("n1")), "g1").join(per.select(F.col("genome").alias("g2"), F.col("n").alias("n2")), "g2")
    return out.select("g1", "g2", (F.col("shared") * 100 / (F.col("n1") + F.col("n2") - F.col("shared"))).alias("jaccard"))


def group_cutoffs(total: Column, true_percent: Column, false_percent: Column) -> tuple[Column, Column]:
    """Counts from which a group has a cluster, and up to which it lacks it."""
    t, f = total * true_percent / 100, total * false_percent / 100
    t2 = F.when((t > total - 1) & (t < total), F.greatest(total - 1, F.lit(1)).cast("double")).otherwise(t)
    f2 = F.when((f > 0) & (f < 1), F.lit(1.0)).otherwise(f)
    return t2, F.when(t2 == f2, t2 - 1).otherwise(f2)


def group_labels(members: DataFrame, groups: DataFrame, thresholds: list[tuple[float, float]]) -> DataFrame:
    """cluster, true_percent, labels: for each threshold pair the labels of all groups, sorted, joined by commas.

    groups: genome, label. A group's label stands alone where the cluster is in
    enough of its genomes, with not_ where in few, with amb_ between.
    """
    totals = groups.groupBy("label").agg(F.countDistinct("genome").alias("total"))
    counts = members.join(F.broadcast(groups), "genome").groupBy("cluster", "label").agg(F.countDistinct("genome").alias("n"))
    by = counts.groupBy("cluster").agg(F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("by"))
    every = totals.agg(F.collect_list(F.struct("label", "total")).alias("every"))  # one row for each group
    limits = F.array(*(F.struct(F.lit(float(t)).alias("t"), F.lit(float(f)).alias("f")) for t, f in thresholds))
    rows = by.join(F.broadcast(every)).select("cluster", "by", F.explode("every").alias("g"), limits.alias("limits"))
    rows = rows.select("cluster", F.coalesce(F.element_at("by", F.col("g.label")), F.lit(0)).alias("n"), "g", F.explode("limits").alias("limit"))
    t, f = group_cutoffs(F.col("g.total"), F.col("limit.t"), F.col("limit.f"))
    label = F.when(F.col("n") >= t, F.col("g.label")).when(F.col("n") <= f, F.concat(F.lit("not_"), "g.label")).otherwise(F.concat(F.lit("amb_"), "g.label"))
    return rows.select("cluster", F.col("limit.t").alias("true_percent"), label.alias("label")).groupBy("cluster", "true_percent").agg(F.array_join(F.sort_array(F.collect_list("label")), ",").alias("labels"))


def label_combinations(labels: DataFrame) -> DataFrame:
    """labels, true_percent, clusters."""
    return labels.groupBy("labels", "true_percent").agg(F.count(F.lit(1)).alias("clusters"))


def role_rollup(facts: DataFrame, main: str, sub: str) -> DataFrame:
    """main, sub, clusters with a subtotal for each main role (sub null) and a grand total."""
    return facts.rollup(main, sub).agg(F.countDistinct("cluster").alias("clusters"))


def group_matchtable(members: DataFrame, groups: DataFrame) -> DataFrame:
    """group, genome, n: members of all clusters of a paralog group; groups: cluster, group."""
    return members.join(groups, "cluster").groupBy("group", "genome").agg(F.count(F.lit(1)).alias("n"))


def island_weights(members: DataFrame, islands: DataFrame) -> DataFrame:
    """fgi, genome, weight: percent of the island's clusters that a genome has."""
    size = islands.groupBy("fgi").agg(F.countDistinct("cluster").alias("total"))
    have = members.join(islands, "cluster").groupBy("fgi", "genome").agg(F.countDistinct("cluster").alias("n"))
    return have.join(size, "fgi").select("fgi", "genome", (F.col("n") * 100 / F.col("total")).alias("weight"))


def joined_values(rows: DataFrame, key: str, value: str, separator: str = ",") -> DataFrame:
    """key, values: distinct values in order, joined."""
    return rows.groupBy(key).agg(F.array_join(F.sort_array(F.collect_set(value)), separator).alias("values"))


def match_summary(members: DataFrame, chosen: DataFrame) -> DataFrame:
    """genome, n, and a Total(n) row over the chosen clusters."""
    picked = members.join(chosen, "cluster", "left_semi")
    out = picked.rollup("genome").agg(F.count(F.lit(1)).alias("n"), F.grouping("genome").alias("all"))
    return out.select(F.when(F.col("all") == 1, F.lit("Total")).otherwise(F.col("genome").cast("string")).alias("genome"), "n")


def matchtable(members: DataFrame, genomes: list) -> DataFrame:
    """cluster and a 0/1 column for each listed genome."""
    wide = members.groupBy("cluster").pivot("genome", genomes).agg(F.lit(1))
    return wide.select("cluster", *(F.coalesce(F.col(f"`{g}`"), F.lit(0)).alias(f"g{g}") for g in genomes))


def rarefaction(members: DataFrame, combinations: DataFrame, core_percent: float = 100, novel_most: int = 1) -> DataFrame:
    """combo, size, core, dispensable, unique, pan, novel.

    combinations: combo, place (from 1), genome. core counts clusters in at least trunc(size x percent / 100)
    of the genomes, at least one; novel those whose only genome is the last of the combination. Members are dealt by cluster
    before each is repeated for its combinations, so these rows are added up where they are.
    """
    size = combinations.groupBy("combo").agg(F.count(F.lit(1)).alias("size"))
    got = members.repartition("cluster").join(F.broadcast(combinations), "genome").groupBy("combo", "cluster").agg(F.count(F.lit(1)).alias("n"), F.max("place").alias("last"))
    got = got.join(size, "combo")
    base = F.floor(F.col("size") * core_percent / 100)
    need = F.greatest(F.when((F.col("size") < 10) & (base < F.col("size")), base + 1).otherwise(base), F.lit(1))
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return got.groupBy("combo", "size").agg(
        count(F.col("n") >= need).alias("core"),
        count((F.col("n") < need) & (F.col("n") > novel_most)).alias("dispensable"),
        count((F.col("n") <= novel_most) & (F.col("n") < need)).alias("unique"),
        F.count(F.lit(1)).alias("pan"),
        count((F.col("n") == 1) & (F.col("last") == F.col("size"))).alias("novel"),
    )


def prevalence_tallies(members: DataFrame, n_genomes: int) -> DataFrame:
    """genome, bucket, n: members by how common their cluster is (75 and more, 25 and less percent, between)."""
    share = F.col("n_genomes") * 100 / n_genomes
    bucket = F.when(share >= 75, "common").when(share <= 25, "rare").otherwise("middle")
    return members.join(sizes(members), "cluster").groupBy("genome", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def single_copy_core(members: DataFrame, paralogs: DataFrame, at_least: int) -> DataFrame:
    """cluster of at least so many genomes and without paralogs."""
    return sizes(members).where(F.col("n_genomes") >= at_least).join(paralogs, "cluster", "left_anti").select("cluster")


def by_size(members: DataFrame, low: int, high: int) -> DataFrame:
    return sizes(members).where(F.col("n_genomes").between(low, high))


def numbering(members: DataFrame, order: list[str]) -> DataFrame:
    """cluster, number from 1, in the order of each cluster's first member by the columns.

    The first members are found by aggregation; numbers come from counts of ranges, not from one sort of all rows in a task.
    """
    first = members.groupBy("cluster").agg(F.min(F.struct(*order)).alias("first"))
    named = numbered(first, "first", "cluster")
    return named.select("cluster", F.col("k").alias("number"))


def combinations(genomes: DataFrame, size: int, sample: int = 0, seed: int = 123) -> DataFrame:
    """combo, place (from 1), genome: every combination of so many of the genomes, or that many sampled ones.

    All are built by joins, each adding a later genome; a sample takes, for each number, the genomes with the smallest
    hashes of seed, number and genome, so it is the same whatever the partitions, and samples may repeat.
    """
    g = genomes.select("genome").distinct()
    if sample:
        number = g.sparkSession.range(sample).select(F.col("id").alias("combo"))
        every = F.broadcast(g.agg(F.array_sort(F.collect_list("genome")).alias("every")))  # the genome list, one row
        hashed = F.transform("every", lambda x: F.struct(F.xxhash64(F.lit(seed), F.col("combo"), x).alias("h"), x.alias("genome")))
        return number.join(every).select("combo", F.posexplode(F.slice(F.array_sort(hashed), 1, size)).alias("place", "x")).select("combo", (F.col("place") + 1).alias("place"), "x.genome")
    got = g.select(F.array("genome").alias("c"))
    for k in range(1, size):
        got = got.join(g, F.element_at("c", k) < F.col("genome")).select(F.array_append("c", F.col("genome")).alias("c"))
    return got.select(F.array_join(F.transform("c", lambda x: x.cast("string")), "-").alias("combo"), F.posexplode("c").alias("place", "genome")).select("combo", (F.col("place") + 1).alias("place"), "genome")


def assemblies(rows: DataFrame, term: str, excluded: DataFrame, min_n50: int, max_contigs: int, levels: tuple[str, ...] = ("Complete Genome", "WGS")) -> DataFrame:
    """The rows of the latest version, at one of the levels, whose name has the term, of enough N50 and few enough contigs, that the list (accession) doesn't exclude."""
    good = (F.col("version") == "latest") & F.col("level").isin(*levels) & F.col("name").contains(term)
    return rows.where(good & (F.col("n50") >= min_n50) & (F.col("contigs") <= max_contigs)).join(excluded.select("accession"), "accession", "left_anti").select(*rows.columns)
