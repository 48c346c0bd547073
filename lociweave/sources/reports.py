"""Text reports of searches, with rounds and alignment blocks, and flat files of small genomes with joined and slipped locations.

Both are records over many lines. Files are cut at the begin of a record through lineSep, so that one long report is read by many
tasks, and a record's blocks are taken apart in the JVM; a record is one row until then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequence import reverse_complement, wrap

#: The lines that begin and end the parts of a report.
QUERY, ROUND, LIST, WORSE = "Query=", "Results from round", "Sequences producing significant alignments", "Sequences with E-value WORSE than threshold"


def _number(text: Column) -> Column:
    """A number of a report; `e-20` stands for 1e-20."""
    return F.regexp_replace(text, "^e", "1e").cast("double")


def _rounds(spark: SparkSession, path: str) -> DataFrame:
    """query, round, text: what a report says of a query in each round; a report without rounds has round 1. Other lines than records are left out."""
    t = spark.read.option("lineSep", f"\n{QUERY}").text(path)
    t = t.select(F.regexp_replace("value", "\r", "").alias("value")).select(F.regexp_replace("value", f"^{QUERY}", "").alias("value")).where(F.col("value").contains(LIST) | F.col("value").contains("No hits found"))
    query = F.regexp_extract("value", r"^\s*(\S+)", 1)
    parts = t.select(query.alias("query"), F.posexplode(F.split("value", f"\n{ROUND}")).alias("k", "text"), F.col("value").contains(f"\n{ROUND}").alias("many"))
    number = F.when(F.col("many"), F.regexp_extract("text", r"^\s*(\d+)", 1).cast("int")).otherwise(F.lit(1))
    return parts.where("not many or k > 0").select("query", number.alias("round"), "text")


def report_lists(spark: SparkSession, path: str) -> DataFrame:
    """query, round, place (from 1), subject, bits, evalue, worse of the list that stands before the alignments; worse: below the threshold of the next round."""
    part = F.regexp_extract("text", rf"(?s)\n{LIST}[^\n]*\n(.*?)(?=\n>|\n *Database:|$)", 1)
    whole = _rounds(spark, path).select("query", "round", part.alias("list"))
    row = F.lit(r"(?m)^(?!Sequences )(\S.*\s[0-9.eE+-]+\s+[0-9.eE+-]+) *$")
    rows = lambda c: F.regexp_extract_all(c, row, F.lit(1))
    near = F.size(rows(F.substring_index("list", WORSE, 1)))
    one = whole.select("query", "round", near.alias("near"), F.posexplode(rows(F.col("list"))).alias("k", "line"))
    cell = lambda n: F.regexp_extract("line", r"^(\S+).*?\s([0-9.eE+-]+)\s+([0-9.eE+-]+)$", n)
    return one.select("query", "round", (F.col("k") + 1).alias("place"), cell(1).alias("subject"), _number(cell(2)).alias("bits"), _number(cell(3)).alias("evalue"), (F.col("k") >= F.col("near")).alias("worse"))


def report_alignments(spark: SparkSession, path: str) -> DataFrame:
    """query, round, subject, subject_length, place, bits, evalue, identities, length, gaps, qstart, qend, sstart, send, qseq, sseq of each alignment block."""
    hits = F.explode(F.slice(F.split("text", "\n>"), 2, 1 << 30)).alias("hit")
    h = _rounds(spark, path).where(F.col("text").contains("\n>")).select("query", "round", hits)
    subject, size = F.regexp_extract("hit", r"^\s*(\S+)", 1), F.regexp_extract("hit", r"Length\s*=\s*(\d+)", 1).cast("int")
    h = h.select("query", "round", subject.alias("subject"), size.alias("subject_length"), F.posexplode(F.slice(F.split("hit", r"\n\s*Score\s*="), 2, 1 << 30)).alias("k", "block"))
    field = lambda p, n=1: F.regexp_extract("block", p, n)
    line = lambda name, n: F.regexp_extract_all("block", F.lit(rf"(?m)^{name}:?\s+(\d+)\s+(\S+)\s+(\d+) *$"), F.lit(n))
    h = h.select("*", *(line(name, n).alias(f"{c}{n}") for name, c in (("Query", "q"), ("Sbjct", "s")) for n in (1, 2, 3)))
    first, last = lambda c: F.get(c, F.lit(0)).cast("long"), lambda c: F.element_at(F.col(c), -1).cast("long")
    gaps = F.coalesce(F.nullif(field(r"Gaps\s*=\s*(\d+)/"), F.lit("")).cast("int"), F.lit(0))
    return h.select(
        *("query", "round", "subject", "subject_length", (F.col("k") + 1).alias("place")),
        *(_number(field(r"^\s*([0-9.eE+-]+) bits")).alias("bits"), _number(field(r"Expect(?:\(\d+\))?\s*=\s*([0-9.eE+-]+)")).alias("evalue")),
        *(field(r"Identities\s*=\s*(\d+)/").cast("int").alias("identities"), field(r"Identities\s*=\s*\d+/(\d+)").cast("int").alias("length"), gaps.alias("gaps")),
        *(first("q1").alias("qstart"), last("q3").alias("qend"), first("s1").alias("sstart"), last("s3").alias("send")),
        *(F.array_join("q2", "").alias("qseq"), F.array_join("s2", "").alias("sseq")),
    )


def _blocks(width: int) -> Column:
    """Lines of an alignment, `width` letters each, with the places of their first and last letters; gaps take no place."""
    k = F.sequence(F.lit(0), F.floor((F.length("qseq") - 1) / width).cast("int"))

    def lines(i: Column) -> Column:
        part = lambda c: F.substring(F.col(c), i * width + 1, F.lit(width))
        letters = lambda x: F.length(F.regexp_replace(x, "-", ""))
        before = lambda c: letters(F.substring(F.col(c), F.lit(1), i * width))
        way = F.when(F.col("sstart") <= F.col("send"), 1).otherwise(-1)
        row = lambda name, c, start, s: F.concat_ws(" ", F.lit(name), (start + s * before(c)).cast("string"), part(c), (start + s * (before(c) + letters(part(c)) - 1)).cast("string"))
        return F.concat_ws("\n", row("Query:", "qseq", F.col("qstart"), F.lit(1)), F.lit(""), row("Sbjct:", "sseq", F.col("sstart"), way), F.lit(""))

    return F.array_join(F.transform(k, lines), "\n")


def write_report(alignments: DataFrame, path: str, threshold: float, width: int = 60) -> None:
    """A text report with rounds: one record a query, in files packed by gzip, one a task. alignments: as report_alignments gives, best dealt by query, as then nothing is shuffled; subjects with a least e-value above the threshold are listed as worse."""
    number = lambda c: F.col(c).cast("string")
    head = F.concat(F.lit(" Score = "), number("bits"), F.lit(" bits (1),  Expect = "), number("evalue"), F.lit("\n Identities = "), number("identities"), F.lit("/"), number("length"), F.lit(" (1%), Gaps = "), number("gaps"), F.lit("/"), number("length"))
    a = alignments.select("query", "round", "subject", "subject_length", "place", "bits", "evalue", F.concat(head, F.lit("\n\n"), _blocks(width)).alias("block"))
    s = a.groupBy("query", "round", "subject", "subject_length").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "block"))), lambda x: x["block"]), "\n").alias("blocks"), F.min("evalue").alias("evalue"), F.max("bits").alias("bits"))
    row = F.concat_ws(" ", "subject", F.lit("some description ..."), number("bits"), number("evalue"))
    hit = F.struct("evalue", "subject", row.alias("row"), F.concat(F.lit("\n>"), F.col("subject"), F.lit(" some description\n          Length = "), number("subject_length"), F.lit("\n\n"), F.col("blocks")).alias("text"))
    r = s.groupBy("query", "round").agg(F.array_sort(F.collect_list(hit)).alias("h"))
    names = lambda keep: F.array_join(F.transform(F.filter("h", keep), lambda x: x["row"]), "\n")
    text = F.concat(F.lit(f"\n{ROUND} "), number("round"), F.lit(f"\n\n{LIST}:        (bits) Value\n\n"), names(lambda x: x["evalue"] <= threshold), F.lit(f"\n\n{WORSE}\n\n"), names(lambda x: x["evalue"] > threshold), F.lit("\n"), F.array_join(F.transform("h", lambda x: x["text"]), "\n"))
    q = r.select("query", "round", text.alias("text")).groupBy("query").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("round", "text"))), lambda x: x["text"]), "\n").alias("text"))
    q.select(F.concat(F.lit(f"BLASTP 2.2\n\n{QUERY} "), F.col("query"), F.lit(" some query\n         (100 letters)\n"), F.col("text"), F.lit("\n  Database: all\n")).alias("value")).write.text(path, compression="gzip")


#: Features of small genomes that are read, and those whose product or note goes into their name.
KINDS, WITH_PRODUCT, WITH_NOTE, UNTRANSLATED = ("gene", "mat_peptide", "stem_loop", "5'UTR", "3'UTR"), ("gene", "mat_peptide"), ("stem_loop",), {"5'UTR": "5putr", "3'UTR": "3putr"}


def _records(spark: SparkSession, path: str, strip_version: bool) -> DataFrame:
    """locus, contig, length, origin, features of flat-file records; an origin of another length than the record says, or none, is an error."""
    t = spark.read.option("lineSep", "\n//").text(path).select(F.regexp_replace("value", "\r", "").alias("v")).where(F.col("v").contains("LOCUS"))
    get = lambda p, n=1: F.regexp_extract("v", p, n)
    version = get(r"(?m)^\s*VERSION\s+(\S+)")
    t = t.select(
        F.regexp_replace(get(r"LOCUS\s+(\S+)"), r"\.\d+$", "").alias("locus"),
        (F.regexp_replace(version, r"\.\d+$", "") if strip_version else version).alias("contig"),
        get(r"LOCUS\s+\S+\s+(\d+)\s+bp").cast("long").alias("length"),
        F.upper(F.regexp_replace(get(r"(?s)\nORIGIN[^\n]*\n(.*)$"), "[^a-zA-Z]", "")).alias("origin"),
        F.concat(F.lit("\n"), get(r"(?s)\nFEATURES[^\n]*\n(.*?)(?=\nORIGIN|\nCONTIG|$)")).alias("features"),
    )
    fine = F.length("origin") == F.col("length")
    return t.where(F.when(fine, True).otherwise(F.raise_error(F.concat(F.lit("length of the sequence differs in "), F.col("locus"))).cast("boolean")))


def viral_features(spark: SparkSession, path: str, strip_version: bool = True) -> DataFrame:
    """locus, contig, number (from 0), kind, start, stop, inverted, annotation, seq of genes, mature peptides, stem loops and untranslated ends.

    A feature's annotation is its last gene name, or that of the feature before where it has none, with the products that follow it (genes and mature
    peptides; a coding sequence belongs to the gene before it) or the notes (stem loops). A place beyond the record's length is an error.
    """
    kinds = "|".join(KINDS)
    begin = rf"\n\s*(?:{kinds})\s+\d+\.\.\d+"
    r = _records(spark, path, strip_version)
    blocks = F.regexp_extract_all("features", F.lit(rf"(?s)({begin}.*?)(?={begin}|$)"), F.lit(1))
    get = lambda x, p, n=1: F.regexp_extract(x, p, n)

    def part(x: Column) -> Column:
        kind = get(x, rf"^\n\s*({kinds})\s")
        after = F.when(get(x, r'(?s)^.*/gene="([^"]*)"', 0) != "", get(x, r'(?s)^.*/gene="[^"]*"(.*)$')).otherwise(x)
        words = lambda n: F.regexp_extract_all(after, F.lit(rf'/{n}="([^"]*)"'), F.lit(1))
        more = F.when(kind.isin(*WITH_PRODUCT), words("product")).when(kind.isin(*WITH_NOTE), words("note")).otherwise(F.array().cast("array<string>"))
        name = F.when(get(x, r'(?s)^.*/gene="([^"]*)"', 0) != "", get(x, r'(?s)^.*/gene="([^"]*)"')).when(kind.isin(*UNTRANSLATED), kind)
        place = lambda n: get(x, rf"^\n\s*(?:{kinds})\s+(\d+)\.\.(\d+)", n).cast("long")
        return F.struct(kind.alias("kind"), place(1).alias("a"), place(2).alias("b"), name.alias("name"), F.array_join(F.transform(more, lambda w: F.concat(F.lit(" "), w)), "").alias("more"), F.lit("").alias("annotation"))

    parts = F.transform(blocks, part)

    def fold(done: Column, x: Column) -> Column:
        before = F.when(F.size(done) > 0, F.element_at(done, -1)["annotation"]).otherwise("")
        return F.array_append(done, x.withField("annotation", F.concat(F.coalesce(x["name"], before), x["more"])))

    r = r.withColumn("parts", parts).withColumn("parts", F.aggregate("parts", F.slice("parts", 1, 0), fold))
    f = r.select("locus", "contig", "length", "origin", F.posexplode("parts").alias("number", "x")).select("*", "x.*")
    renamed = F.coalesce(*(F.when(F.col("kind") == k, v) for k, v in UNTRANSLATED.items()), F.col("kind"))
    start, stop = F.least("a", "b"), F.greatest("a", "b")
    fine = F.when(stop <= F.col("length"), True).otherwise(F.raise_error(F.concat(F.lit("a place is beyond the sequence in "), F.col("locus"))).cast("boolean"))
    seq = F.substring(F.col("origin"), start, stop - start + 1)
    return f.where(fine).select("locus", "contig", "number", renamed.alias("kind"), start.alias("start"), stop.alias("stop"), (F.col("a") > F.col("b")).alias("inverted"), "annotation", F.when(F.col("a") > F.col("b"), reverse_complement(seq)).otherwise(seq).alias("seq"))


def spliced(origin: Column, location: Column) -> Column:
    """The sequence of a location: parts of a join in order, also where they overlap (a slip) or are turned one by one; complement around all turns the whole."""
    bare = F.regexp_replace(location, r"\s|[<>]", "")
    turned = bare.startswith("complement(join") | bare.rlike(r"^complement\(\d")
    inner = F.when(turned, F.regexp_extract(bare, r"^complement\((.*)\)$", 1)).otherwise(bare)
    each = F.regexp_extract_all(inner, F.lit(r"(complement\(\d+(?:\.\.\d+)?\)|\d+(?:\.\.\d+)?)"), F.lit(1))

    def piece(x: Column) -> Column:
        a = F.regexp_extract(x, r"(\d+)", 1).cast("int")
        b = F.coalesce(F.nullif(F.regexp_extract(x, r"\.\.(\d+)", 1), F.lit("")).cast("int"), a)
        s = F.substring(origin, F.least(a, b), F.greatest(a, b) - F.least(a, b) + 1)
        return F.when(x.startswith("complement"), reverse_complement(s)).otherwise(s)

    whole = F.array_join(F.transform(each, piece), "")
    return F.when(turned, reverse_complement(whole)).otherwise(whole)


def viral_coding(spark: SparkSession, path: str, strip_version: bool = True) -> DataFrame:
    """locus, contig, number (from 0), location, slips, product, coding of coding sequences, spliced from the record's sequence; slips: parts that begin no later than the one before ends."""
    feature = F.lit(r"(?s)\n {5}CDS +(.*?)(?=\n {5}\S|$)")
    r = _records(spark, path, strip_version).select("locus", "contig", "origin", F.posexplode(F.regexp_extract_all("features", feature, F.lit(1))).alias("number", "f"))
    location = F.regexp_replace(F.regexp_extract("f", r"(?s)^(.*?)(?=\n\s+/|$)", 1), r"\s", "")
    product = F.regexp_replace(F.regexp_extract("f", r'(?s)/product="(.*?)"', 1), r"\s*\n\s+", " ")
    r = r.select("locus", "contig", "number", location.alias("location"), product.alias("product"), "origin")
    ends = F.transform(F.regexp_extract_all("location", F.lit(r"(\d+(?:\.\.\d+)?)"), F.lit(1)), lambda x: F.struct(F.split_part(x, F.lit(".."), F.lit(1)).cast("int").alias("a"), F.substring_index(x, "..", -1).cast("int").alias("b")))
    r = r.withColumn("e", ends)
    slips = F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.size("e"), F.lit(1))), lambda i: (i > 1) & (F.get("e", i - 1)["a"] <= F.get("e", i - 2)["b"])))
    return r.select("locus", "contig", "number", "location", slips.alias("slips"), "product", spliced(F.col("origin"), F.col("location")).alias("coding"))


def write_viral(records: DataFrame, path: str) -> None:
    """Flat files of one record a row: locus, version, origin, features: an array of (kind, location, gene, product, note), qualifiers null where there are none."""
    quoted = lambda x, n: F.when(x[n].isNotNull(), F.concat(F.lit(f'\n                     /{n}="'), x[n], F.lit('"')))
    text = F.transform("features", lambda x: F.concat(F.lit("     "), F.rpad(x["kind"], 16, " "), x["location"], *(F.coalesce(quoted(x, n), F.lit("")) for n in ("gene", "product", "note"))))
    origin = F.concat(F.lit("        1 "), F.lower(F.regexp_replace(wrap(F.col("origin")), "\n", "\n        1 ")))
    value = F.concat_ws("\n", F.concat_ws(" ", F.lit("LOCUS      "), "locus", F.length("origin").cast("string"), F.lit("bp    RNA")), F.concat(F.lit("VERSION     "), F.col("version")), F.lit("FEATURES             Location/Qualifiers"), F.array_join(text, "\n"), F.lit("ORIGIN"), origin, F.lit("//"))
    records.select(value.alias("value")).write.text(path)
