"""Readers of the field's text formats as DataFrames. Paths are what spark.read takes: folders, globs, compressed files.

Records that end at a line stay splittable; FASTA splits at '\\n>' through lineSep, so that long files are read in parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.sequence import coordinates

#: Columns of tabular search results.
HIT_COLUMNS = "qid string, sid string, pid double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, evalue double, bitscore double"
ABSENT = "^(-{2,}|)$"


def lines(spark: SparkSession, path: str, comment: str | None = "#") -> DataFrame:
    t = spark.read.text(path).where(F.trim("value") != "")
    return t.where(~F.col("value").startswith(comment)) if comment else t


def genome_list(spark: SparkSession, path: str) -> DataFrame:
    """genome, genome_idx (from 0, the order in the file); a repeated name is an error when rows are read.

    The list is one small file: its order is the order of byte offsets.
    """
    t = lines(spark, path).select(F.trim("value").alias("genome"), "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
    whole = t.agg(F.collect_list(F.struct("at", "genome")).alias("g")).select(F.array_sort("g").alias("g"))
    same = F.size(F.array_distinct(F.col("g.genome"))) == F.size("g")
    whole = whole.select(F.when(same, F.col("g")).otherwise(F.raise_error(F.lit("a genome is listed twice"))).alias("g"))
    return whole.select(F.posexplode("g.genome").alias("genome_idx", "genome")).select("genome", "genome_idx")


def fasta(spark: SparkSession, path: str, letters: str = "a-zA-Z*-") -> DataFrame:
    """id, header, seq, len."""
    t = spark.read.option("lineSep", "\n>").text(path).where(F.trim("value") != "")
    record = F.regexp_replace("value", "^>", "")
    header = F.regexp_replace(F.substring_index(record, "\n", 1), "\r$", "")
    body = F.when(F.instr(record, "\n") > 0, F.substring(record, F.instr(record, "\n") + 1, F.length(record)))
    seq = F.coalesce(F.regexp_replace(body, f"[^{letters}]", ""), F.lit(""))
    return t.select(F.regexp_extract(header, r"^\s*(\S+)", 1).alias("id"), header.alias("header"), seq.alias("seq")).withColumn("len", F.length("seq"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, n (from 0), value of all lines, numbered file by file: each split numbers its own lines, after the counts of the splits before it."""
    t = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("_id"))
    counts = t.groupBy("file", "block").agg(F.count(F.lit(1)).alias("lines"))
    before = counts.select("file", "block", (F.sum("lines").over(Window.partitionBy("file").orderBy("block")) - F.col("lines")).alias("before"))
    own = F.row_number().over(Window.partitionBy("file", "block").orderBy("_id"))  # a split's lines
    return t.withColumn("_own", own).join(before, ["file", "block"]).select("file", (F.col("before") + F.col("_own") - 1).alias("n"), "value")


def fastq(spark: SparkSession, path: str) -> DataFrame:
    """id, seq, quality of four-line records, which may lie on both sides of a split; blank lines at the end of a file don't matter."""
    at = lambda k: F.max(F.when(F.col("n") % 4 == k, F.regexp_replace("value", "\r$", "")))
    r = numbered_lines(spark, path).groupBy("file", F.floor(F.col("n") / 4).alias("r")).agg(at(0).alias("head"), at(1).alias("seq"), at(2).alias("plus"), at(3).alias("quality"))
    r = r.where("head <> ''")
    fine = F.col("head").startswith("@") & F.col("plus").startswith("+") & (F.length("seq") == F.length("quality"))
    return checked(r, F.coalesce(fine, F.lit(False)), "a record is not four lines of FASTQ").select(F.regexp_extract("head", r"^@(\S*)", 1).alias("id"), "seq", "quality")


def sequence_records(spark: SparkSession, path: str) -> DataFrame:
    """id, seq, quality of files in FASTA or FASTQ, each told by its first letter; quality is null in FASTA. The list of files, as Spark lists them, comes to the driver."""
    first = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").substr(1, 1).alias("c"), F.monotonically_increasing_id().alias("_id"))
    kinds = first.where("block = 0").groupBy("file").agg(F.min_by("c", "_id").alias("c")).collect()
    files = {c: [r["file"] for r in kinds if r["c"] == c] for c in ">@"}
    none = spark.createDataFrame([], "id string, seq string, quality string")
    one = fasta(spark, files[">"]).select("id", "seq", F.lit(None).cast("string").alias("quality")) if files[">"] else none
    return one.unionByName(fastq(spark, files["@"])) if files["@"] else one


def attributes(spark: SparkSession, path: str) -> DataFrame:
    """contig, feat, end5, end3, annotation, genome [, protein, role_id, hmms] with start, stop, orient."""
    schema = "contig string, feat string, end5 int, end3 int, annotation string, genome string, protein string, role_id string, hmms string"
    t = spark.read.csv(path, sep="\t", schema=schema, mode="PERMISSIVE", quote="")
    lists = {c: F.when(F.col(c).isNotNull(), F.split(c, r"\|")) for c in ("role_id", "hmms")}
    return t.withColumns(lists | {"start": F.least("end5", "end3"), "stop": F.greatest("end5", "end3"), "orient": F.when(F.col("end5") < F.col("end3"), 1).otherwise(-1)})


def topology(spark: SparkSession, path: str) -> DataFrame:
    """genome, contig, is_circular; any other word than circular or linear is an error."""
    t = spark.read.csv(path, sep="\t", schema="genome string, contig string, type string")
    wrong = F.raise_error(F.concat(F.lit("unknown topology "), F.col("type")))
    return t.select("genome", "contig", F.when(F.col("type") == "circular", True).when(F.col("type") == "linear", False).otherwise(wrong.cast("boolean")).alias("is_circular"))


def hits(spark: SparkSession, path: str) -> DataFrame:
    """Tabular hits of 12 columns, or of 20 and more in the older order; each line is told by its width."""
    c = F.split("value", "\t")
    old = F.size(c) >= 20
    at = lambda new, wide: F.when(old, F.get(c, F.lit(wide)) if wide is not None else None).otherwise(F.get(c, F.lit(new)))
    places = {"qid": (0, 0), "sid": (1, 5), "pid": (2, 10), "length": (3, None), "mismatch": (4, None), "gapopen": (5, None), "qstart": (6, 6), "qend": (7, 7), "sstart": (8, 8), "send": (9, 9), "evalue": (10, 19), "bitscore": (11, 12)}
    kinds = dict(x.split() for x in HIT_COLUMNS.split(", "))
    return lines(spark, path).select(*(F.trim(at(*p)).cast(kinds[n]).alias(n) for n, p in places.items()))


def matchtable(spark: SparkSession, path: str, genomes: list[str]) -> DataFrame:
    """cluster, genome, feat of the members that are there; a row of another width is an error."""
    c = F.split("value", "\t", -1)
    ok = F.when(F.size(c) == len(genomes) + 1, c).otherwise(F.raise_error(F.lit("row width differs from the number of genomes")))
    e = lines(spark, path).select(ok.alias("c")).select(F.get("c", F.lit(0)).cast("long").alias("cluster"), F.posexplode(F.slice("c", 2, len(genomes))).alias("k", "feat"))
    return e.where(~F.col("feat").rlike(ABSENT)).select("cluster", F.get(F.array(*map(F.lit, genomes)), F.col("k")).alias("genome"), "feat")


def adjacency(spark: SparkSession, path: str, genomes: list[str]) -> DataFrame:
    """c1, e1, c2, e2, genome of edges `(c1_e1,c2_e2)` followed by a 0 or 1 for each genome."""
    c = F.split("value", "\t")
    part = lambda k: F.regexp_extract(F.get(c, F.lit(0)), r"^\((\d+)_([35]),(\d+)_([35])\)$", k)
    e = lines(spark, path).select(part(1).cast("long").alias("c1"), part(2).cast("int").alias("e1"), part(3).cast("long").alias("c2"), part(4).cast("int").alias("e2"), F.posexplode(F.slice(c, 2, len(genomes))).alias("k", "bit"))
    return e.where("bit = '1'").select("c1", "e1", "c2", "e2", F.get(F.array(*map(F.lit, genomes)), F.col("k")).alias("genome"))


def asymmetric_edges(edges: DataFrame) -> DataFrame:
    """Edges whose reverse is missing."""
    back = edges.select(F.col("c2").alias("c1"), F.col("e2").alias("e1"), F.col("c1").alias("c2"), F.col("e1").alias("e2"), "genome")
    return edges.join(back, ["c1", "e1", "c2", "e2", "genome"], "left_anti")


def hmm_table(spark: SparkSession, path: str, fields: int = 18) -> DataFrame:
    """target, accession, query, evalue, score, description of search tables in blank-separated columns."""
    c = F.split(F.trim("value"), r"\s+")
    get = lambda k: F.get(c, F.lit(k))
    return lines(spark, path).select(get(0).alias("target"), get(1).alias("accession"), get(2).alias("query"), get(4).cast("double").alias("evalue"), get(5).cast("double").alias("score"), F.array_join(F.slice(c, fields + 1, F.greatest(F.size(c) - fields, F.lit(0))), " ").alias("description"))


def hmm_domains(spark: SparkSession, path: str) -> DataFrame:
    """target, query, domain, evalue, score, hmm_start, hmm_stop, start, stop of tables of domains, in 22 columns and a description; evalue is the independent one."""
    c = F.split(F.trim("value"), r"\s+")
    places = {"target": (0, "string"), "query": (3, "string"), "domain": (9, "int"), "evalue": (12, "double"), "score": (13, "double"), "hmm_start": (15, "int"), "hmm_stop": (16, "int"), "start": (17, "int"), "stop": (18, "int")}
    return lines(spark, path).where(F.size(c) >= 22).select(*(F.get(c, F.lit(k)).cast(kind).alias(n) for n, (k, kind) in places.items()))


def attribute_problems(attributes: DataFrame) -> DataFrame:
    """feat, problem: features of an attribute table without places or with one only, with an empty name, or listed more than once."""
    several = attributes.groupBy(F.col("feat").alias("_feat")).agg(F.count(F.lit(1)).alias("n"))
    kinds = F.array(F.when(F.col("end5").isNull() | F.col("end3").isNull(), "no place"), F.when(F.col("end5") == F.col("end3"), "no extent"), F.when(F.col("n") > 1, "listed twice"), F.when(F.coalesce("feat", F.lit("")) == "", "no name"))
    rows = attributes.join(several, F.col("feat").eqNullSafe(F.col("_feat")), "left").select("feat", "end5", "end3", "n")
    return rows.select("feat", F.explode(F.filter(kinds, lambda x: x.isNotNull())).alias("problem")).distinct()


def filtered_hits(spark: SparkSession, path: str, identity: float, coverage: float, lengths: DataFrame) -> DataFrame:
    """Tabular hits of at least this identity that cover this share of the query; lengths: qid, qlen. The filter on identity is applied as lines are read."""
    h = hits(spark, path).where(F.col("pid") >= identity)
    share = (F.col("qend") - F.col("qstart") + 1) / F.col("qlen")
    return h.join(lengths, "qid").where(share >= coverage).withColumn("coverage", F.round(share, 9))


def term_mapping(spark: SparkSession, path: str) -> DataFrame:
    """accession, name, term, term_name of lines `Pfam:ACC NAME > GO:text ; GO:id`."""
    part = lambda k: F.regexp_extract("value", r"^\w+:(\S+)\s+(\S+)\s+>\s+GO:(.*?)\s+;\s+(GO:\d+)", k)
    return lines(spark, path, "!").select(part(1).alias("accession"), part(2).alias("name"), part(4).alias("term"), part(3).alias("term_name")).where("accession <> ''")


def hierarchy(spark: SparkSession, path: str) -> DataFrame:
    """level, batch, ref, part of lines `L1B2(a,b,c)`."""
    part = lambda k: F.regexp_extract("value", r"^\s*L(\d+)B(\d+)\s*\((.*)\)\s*$", k)
    t = lines(spark, path).select(part(1).cast("int").alias("level"), part(2).cast("int").alias("batch"), F.explode(F.split(part(3), r"\s*,\s*")).alias("part"))
    return t.select("level", "batch", F.format_string("L%dB%d", "level", "batch").alias("ref"), F.trim("part").alias("part"))


def groupings(spark: SparkSession, path: str, genomes: DataFrame) -> DataFrame:
    """genome, grp, label, short; a genome that is not listed is an error."""
    t = spark.read.csv(path, sep="\t", schema="genome string, grp string, label string, short string")
    j = t.join(genomes.select("genome", F.lit(True).alias("_known")), "genome", "left")
    wrong = F.raise_error(F.concat(F.lit("unknown genome "), F.col("genome")))
    return j.select(F.when(F.col("_known"), F.col("genome")).otherwise(wrong.cast("string")).alias("genome"), "grp", "label", "short")


def distance_matrix(spark: SparkSession, path: str) -> DataFrame:
    """a, b, distance, both directions, from a square or triangular matrix with a header."""
    t = spark.read.csv(path, sep="\t", header=True)
    names = t.columns[1:]
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("b"), F.expr(f"try_cast(`{n}` as double)").alias("distance")) for n in names)))
    long = t.select(F.col(f"`{t.columns[0]}`").alias("a"), pairs.alias("p")).select("a", "p.b", "p.distance").where("distance is not null and a <> b")
    return long.union(long.select("b", "a", "distance")).groupBy("a", "b").agg(F.min("distance").alias("distance"))


def model_database(spark: SparkSession, path: str) -> DataFrame:
    """model_id and its record of a JSON object whose numeric keys are models."""
    t = spark.read.text(path, wholetext=True)
    e = t.select(F.explode(F.from_json("value", "map<string, string>", {"mode": "PERMISSIVE"})).alias("key", "record"))
    return e.where(F.col("key").rlike("^[0-9]+$")).select(F.col("key").alias("model_id"), F.get_json_object("record", "$.model_name").alias("name"), F.get_json_object("record", "$.model_type").alias("type"), "record")


def resource_logs(spark: SparkSession, path: str) -> DataFrame:
    """file, cpu_s, max_rss_mb of verbose time reports."""
    t = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    number = lambda p: F.regexp_extract("value", p + r":\s+([0-9.]+)", 1).try_cast("double")
    return t.groupBy("file").agg((F.max(number(r"User time \(seconds\)")) + F.max(number(r"System time \(seconds\)"))).alias("cpu_s"), (F.max(number(r"Maximum resident set size \(kbytes\)")) / 1000).alias("max_rss_mb"))


def gff_exons(spark: SparkSession, path: str, kind: str = "exon") -> DataFrame:
    """contig, kind, start, stop, strand, attributes (a map) of feature lines."""
    t = spark.read.csv(path, sep="\t", comment="#", schema="contig string, source string, kind string, start int, stop int, score string, strand string, phase string, attributes string")
    return t.where(F.col("kind") == kind).select("contig", "kind", "start", "stop", "strand", F.str_to_map("attributes", F.lit(";"), F.lit("=")).alias("attributes"))


def genbank(spark: SparkSession, path: str) -> DataFrame:
    """locus, kind, location, end5, end3, locus_tag, product, translation of the features of flat files; a record is one row until it is cut."""
    t = spark.read.option("lineSep", "\n//").text(path).where(F.col("value").contains("LOCUS"))
    part = F.regexp_extract("value", r"(?s)\nFEATURES[^\n]*\n(.*?)(?:\nORIGIN|\nCONTIG|$)", 1)
    features = F.regexp_extract_all(F.concat(F.lit("\n"), part), F.lit(r"(?s)\n {5}(\S.*?)(?=\n {5}\S|$)"), F.lit(1))
    e = t.select(F.regexp_extract("value", r"LOCUS\s+(\S+)", 1).alias("locus"), F.explode(features).alias("f"))
    word = lambda n: F.nullif(F.regexp_replace(F.regexp_extract("f", f'(?s)/{n}="(.*?)"', 1), r"\s*\n\s+", " "), F.lit(""))
    where = F.regexp_replace(F.regexp_extract("f", r"(?s)^\S+\s+(.*?)(?=\n\s+/|$)", 1), r"\s", "")
    f = e.select("locus", F.regexp_extract("f", r"^(\S+)", 1).alias("kind"), where.alias("location"), word("locus_tag").alias("locus_tag"), word("product").alias("product"), F.regexp_replace(word("translation"), " ", "").alias("translation"))
    return f.withColumn("c", coordinates(F.col("location"))).select("locus", "kind", "location", F.col("c.end5").alias("end5"), F.col("c.end3").alias("end3"), "locus_tag", "product", "translation")


def search_xml(spark: SparkSession, path: str) -> DataFrame:
    """query, hit, evalue, bits, identity of search results in XML."""
    t = spark.read.format("xml").option("rowTag", "Iteration").load(path)
    hit = F.explode("Iteration_hits.Hit").alias("h")
    h = t.select(F.col("`Iteration_query-def`").alias("query"), hit).select("query", F.col("h.Hit_def").alias("hit"), F.col("h.Hit_hsps.Hsp").alias("s"))
    return h.select("query", "hit", F.col("s.Hsp_evalue").cast("double").alias("evalue"), F.col("s.`Hsp_bit-score`").cast("double").alias("bits"), F.col("s.Hsp_identity").cast("int").alias("identity"))


def relational(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A query on a relational store over JDBC; the driver's jar must be on the class path."""
    return spark.read.format("jdbc").option("url", url).option("query", query).options(**options).load()


def checked(df: DataFrame, fine: Column, message: str) -> DataFrame:
    """The rows; reading one that is not fine is an error."""
    return df.where(F.when(fine, True).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def mash_table(spark: SparkSession, path: str) -> DataFrame:
    """a, b, distance, p, shared, sketch of tabular distances; shared hashes come as `shared/sketch`."""
    t = spark.read.csv(path, sep="\t", schema="a string, b string, distance double, p double, s string")
    part = lambda k: F.split_part("s", F.lit("/"), F.lit(k)).cast("long")
    return t.select("a", "b", "distance", "p", part(1).alias("shared"), part(2).alias("sketch"))
