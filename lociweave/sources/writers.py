"""Writers of the field's text formats. Rows are rendered by column expressions and written in parts by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import wrap
from ..operators.graph import settle


def fasta_lines(df: DataFrame, width: int = 60) -> DataFrame:
    """value: a FASTA record for each (header, seq)."""
    return df.select(F.concat(F.lit(">"), "header", F.lit("\n"), wrap(F.col("seq"), width)).alias("value"))


def write_fasta(df: DataFrame, path: str, width: int = 60, by: str | None = None, records: int = 0) -> None:
    """FASTA files; in folders by a column, or of at most so many records each."""
    text = fasta_lines(df, width) if by is None else df.select(by, F.concat(F.lit(">"), "header", F.lit("\n"), wrap(F.col("seq"), width)).alias("value"))
    w = text.write.option("maxRecordsPerFile", records) if records else text.write
    (w.partitionBy(by) if by else w).text(path)


def write_table(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.csv(path, sep="\t", header=header, nullValue="", emptyValue="")


def matchtable_lines(members: DataFrame, genomes: list[str], absent: str = "----------") -> DataFrame:
    """value: cluster and its member in each listed genome. members: cluster, genome, feat."""
    wide = members.groupBy("cluster").pivot("genome", genomes).agg(F.min("feat"))
    return wide.select(F.concat_ws("\t", F.col("cluster").cast("string"), *(F.coalesce(F.col(f"`{g}`"), F.lit(absent)) for g in genomes)).alias("value"))


def member_tables(members: DataFrame, genomes: list) -> DataFrame:
    """cluster, form, value: the further forms of the table of members, a line each.

    members: cluster, genome, feat, header, identity and ratio (score over own score), both to the row's first member. `identity`: members with their
    identity, the first one bare. The other forms have clusters of the first listed genome only, and begin with its member and header: `id` has
    identities, `hits` members with headers, `micro` 100 - 99 x ratio (100.00 where there is none), `ratio` ratios (0 where there is none).
    """
    it = F.first(F.struct("feat", "header", "identity", "ratio"))
    wide = members.groupBy("cluster").pivot("genome", genomes).agg(it)
    cell = [F.col(f"`{g}`") for g in genomes]
    first = F.coalesce(*(F.when(c.isNotNull(), k) for k, c in enumerate(cell)))
    number = lambda x: F.format_string("%5.2f", x)
    or_blank = lambda c, x, blank="": F.when(c.isNotNull(), x).otherwise(blank)
    named = lambda c: F.concat(c["feat"], F.lit(" ["), c["header"], F.lit("]"))
    rows = {
        "identity": [F.when(first == k, c["feat"]).otherwise(or_blank(c, F.concat(c["feat"], F.lit(" ("), number(c["identity"]), F.lit("%)")))) for k, c in enumerate(cell)],
        "id": [cell[0]["feat"], cell[0]["header"], *(or_blank(c, number(c["identity"])) for c in cell[1:])],
        "hits": [named(cell[0]), *(or_blank(c, named(c)) for c in cell[1:])],
        "micro": [cell[0]["feat"], cell[0]["header"], *(or_blank(c, F.format_string("%2.2f", 100 - 99 * c["ratio"]), "100.00") for c in cell[1:])],
        "ratio": [cell[0]["feat"], cell[0]["header"], *(or_blank(c, c["ratio"].cast("string"), "0") for c in cell[1:])],
    }
    lines = [F.when(F.lit(form == "identity") | cell[0].isNotNull(), F.struct(F.lit(form).alias("form"), F.concat_ws("\t", F.col("cluster").cast("string"), *cells).alias("value"))) for form, cells in rows.items()]
    return wide.select("cluster", F.explode(F.filter(F.array(*lines), lambda x: x.isNotNull())).alias("x")).select("cluster", "x.form", "x.value")


def matrix_lines(pairs: DataFrame, names: list[str], offset: float = 0, scale: float = 1, phylip: bool = False) -> DataFrame:
    """name, value: a row of a square matrix (a, b, value) for each name, offset + scale x value to two places."""
    wide = pairs.groupBy(F.col("a").alias("_name")).pivot("b", names).agg(F.min("value"))
    cells = (F.format_string("%7.2f", F.lit(offset) + F.lit(scale) * F.coalesce(F.col(f"`{n}`"), F.lit(0.0))) for n in names)
    return wide.select(F.col("_name").alias("name"), F.concat_ws(" " if phylip else "\t", F.rpad("_name", 10, " ") if phylip else F.col("_name"), *cells).alias("value"))


def gff3_lines(df: DataFrame, source: str, kind: str) -> DataFrame:
    """value: a line for each contig, start, stop, orient, name."""
    strand = F.when(F.col("orient") == 1, "+").otherwise("-")
    return df.select(F.concat_ws("\t", "contig", F.lit(source), F.lit(kind), F.col("start").cast("string"), F.col("stop").cast("string"), F.lit("."), strand, F.lit("0"), F.concat(F.lit("ID="), F.col("name").cast("string"))).alias("value"))


def gaf_lines(df: DataFrame, database: str, date: str, taxon: str) -> DataFrame:
    """value: an association line for each gene, term, aspect."""
    blank = F.lit("")
    return df.select(F.concat_ws("\t", F.lit(database), "gene", "gene", blank, "term", F.lit(f"{database}_REF"), F.lit("IEA"), blank, "aspect", blank, blank, F.lit("gene"), F.lit(f"taxon:{taxon}"), F.lit(date), F.lit(database)).alias("value"))


def write_split(df: DataFrame, main: str, left: str, condition: str) -> None:
    """Rows that meet the condition to one place, all others (null as well) to another."""
    marked = settle(df.withColumn("_main", F.coalesce(F.expr(condition), F.lit(False))))  # evaluated once
    marked.where("_main").drop("_main").write.parquet(main)
    marked.where("not _main").drop("_main").write.parquet(left)


def write_synteny(features: DataFrame, path: str) -> None:
    """The feature table in folders by genome, sorted by contig and place in each file, so that readers prune."""
    features.repartition("genome").sortWithinPartitions("contig", "start").write.partitionBy("genome").parquet(path)


def expression_table(members: DataFrame, attributes: DataFrame, genomes: list) -> DataFrame:
    """cluster, name, role of its first feature, and a 0 or 1 for each listed genome. members: cluster, genome; attributes: cluster, feat, name, role."""
    first = attributes.groupBy("cluster").agg(F.min(F.struct("feat", "name", "role")).alias("f")).select("cluster", "f.name", "f.role")
    wide = members.groupBy("cluster").pivot("genome", genomes).agg(F.lit(1))
    return first.join(wide, "cluster").select("cluster", "name", "role", *(F.coalesce(F.col(f"`{g}`"), F.lit(0)).alias(f"g{g}") for g in genomes))


def statistics_report(members: DataFrame, n_genomes: int, core_percent: float = 95) -> DataFrame:
    """name, value: clusters in all, core, in one genome only, members, and mean members a cluster (two places)."""
    n = members.groupBy("cluster").agg(F.countDistinct("genome").alias("n"))
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    one = n.agg(F.count(F.lit(1)).alias("clusters"), count(F.col("n") * 100 >= n_genomes * core_percent).alias("core"), count(F.col("n") == 1).alias("single"), F.sum("n").alias("members"))
    mean = F.format_string("%.2f", F.col("members") / F.col("clusters"))
    rows = [F.struct(F.lit(k).alias("name"), F.col(k).cast("string").alias("value")) for k in ("clusters", "core", "single", "members")]
    return one.select(F.explode(F.array(*rows, F.struct(F.lit("mean").alias("name"), mean.alias("value")))).alias("r")).select("r.*")
