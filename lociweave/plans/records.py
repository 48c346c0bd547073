"""Queries over records of many lines: reports of searches and flat files of small genomes, written from a driver table and read again."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..sources import reports as P
from .formats import SEQ, fresh, text
from .registry import query
from .standin import sequences, table

ALIGNMENTS = """a AS (SELECT 'p' || l_partkey AS query, l_linenumber % 2 + 1 AS round, 's' || l_suppkey AS subject, CAST(1000 + l_suppkey AS INTEGER) AS subject_length,
 row_number() OVER (PARTITION BY l_partkey, l_linenumber % 2, l_suppkey ORDER BY l_orderkey, l_linenumber) AS place, CAST(l_quantity AS DOUBLE) AS bits, CAST(l_discount AS DOUBLE) AS evalue, CAST(l_linenumber AS INTEGER) AS identities, CAST(30 + l_quantity AS INTEGER) AS length,
 substr(repeat('ACDEFGHIK-', 9), 1, CAST(30 + l_quantity AS INTEGER)) AS qseq, substr(repeat('LKIHGFEDCA', 9), 1, CAST(30 + l_quantity AS INTEGER)) AS sseq, l_linenumber * 3 AS qstart, CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS way FROM lineitem),
alignments AS (SELECT query, round, subject, subject_length, place, bits, evalue, identities, length, CAST(length - length(replace(qseq, '-', '')) AS INTEGER) AS gaps, qstart, qstart + length(replace(qseq, '-', '')) - 1 AS qend, 500 AS sstart, 500 + way * (length - 1) AS send, qseq, sseq FROM a)"""


def alignments(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumns({"query": F.concat(F.lit("p"), text("l_partkey")), "round": (F.col("l_linenumber") % 2 + 1).cast("int"), "subject": F.concat(F.lit("s"), text("l_suppkey"))})
    cells = ("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_discount", "l_returnflag")
    li = li.select("query", "round", "subject", *cells).repartition("query")  # once, while rows are narrow: all that follows goes by query
    n = (30 + F.col("l_quantity")).cast("int")
    letters = lambda s: F.substring(F.repeat(F.lit(s), 9), F.lit(1), n)
    place = F.row_number().over(Window.partitionBy("query", "round", "subject").orderBy("l_orderkey", "l_linenumber"))
    a = li.withColumn("place", place).select(
        *("query", "round", "subject"),
        *((1000 + F.col("l_suppkey")).cast("int").alias("subject_length"), "place", F.col("l_quantity").cast("double").alias("bits"), F.col("l_discount").cast("double").alias("evalue")),
        *(F.col("l_linenumber").cast("int").alias("identities"), n.alias("length"), letters("ACDEFGHIK-").alias("qseq"), letters("LKIHGFEDCA").alias("sseq")),
        *((F.col("l_linenumber") * 3).cast("long").alias("qstart"), F.when(F.col("l_returnflag") == "R", -1).otherwise(1).alias("way")),
    )
    own = F.length(F.replace("qseq", F.lit("-"), F.lit("")))
    a = a.withColumns({"gaps": F.length("qseq") - own, "qend": F.col("qstart") + own - 1, "sstart": F.lit(500).cast("long")})
    return a.withColumn("send", F.col("sstart") + F.col("way") * (F.col("length") - 1)).drop("way")


@query("s08_report_alignments", f"WITH {ALIGNMENTS} SELECT query, round, subject, subject_length, place, bits, evalue, identities, length, gaps, qstart, qend, sstart, send, md5(qseq || ' ' || sseq) AS letters FROM alignments")
def s08_alignments(spark, sf_dir):
    path = fresh(spark)
    P.write_report(alignments(spark, sf_dir), path, 0.05)
    return P.report_alignments(spark, path).withColumn("letters", F.md5(F.concat_ws(" ", "qseq", "sseq"))).drop("qseq", "sseq")


@query("s08_report_lists", f"""WITH {ALIGNMENTS}, s AS (SELECT query, round, subject, max(bits) AS bits, min(evalue) AS evalue FROM alignments GROUP BY ALL)
SELECT query, round, row_number() OVER (PARTITION BY query, round ORDER BY evalue > 0.05, evalue, subject) AS place, subject, bits, evalue, evalue > 0.05 AS worse FROM s""")
def s08_lists(spark, sf_dir):
    path = fresh(spark)
    P.write_report(alignments(spark, sf_dir), path, 0.05)
    return P.report_lists(spark, path)


VIRAL = f"{SEQ}, v AS (SELECT id, seq, length(seq) AS n, length(seq) // 4 AS q FROM sequences)"


def viral_file(spark, sf_dir) -> str:
    """A record for each document: untranslated ends, a gene whose coding sequence slips by one, a mature peptide and a turned loop; a gene alone where there are few letters."""
    s = sequences(spark, sf_dir).select("id", "seq", F.length("seq").alias("n"), F.floor(F.length("seq") / 4).alias("q"))
    none = F.lit(None).cast("string")
    gene = F.concat(F.lit("g"), text("id"))

    def feature(kind, place, gene=none, product=none, note=none):
        return F.struct(F.lit(kind).alias("kind"), place.alias("location"), gene.alias("gene"), product.alias("product"), note.alias("note"))

    q = F.col("q")
    whole = F.array(
        feature("5'UTR", F.format_string("1..%d", q)),
        feature("gene", F.format_string("%d..%d", q + 1, 3 * q), gene),
        feature("CDS", F.format_string("join(%d..%d,%d..%d)", q + 1, 2 * q, 2 * q, 3 * q), gene, F.lit("poly protein")),
        feature("mat_peptide", F.format_string("%d..%d", q + 5, 2 * q), product=F.lit("leader")),
        feature("stem_loop", F.format_string("%d..%d", 3 * q + 4, 3 * q), note=F.lit("loop")),
        feature("3'UTR", F.format_string("%d..%d", 3 * q + 1, F.col("n"))),
    )
    few = F.array(feature("gene", F.format_string("1..%d", F.col("n")), gene))
    features = F.when(F.col("n") >= 24, whole).when(F.col("n") > 0, few).otherwise(F.slice(few, 1, 0))
    path = fresh(spark)
    P.write_viral(s.select(F.concat(F.lit("V"), text("id"), F.lit(".1")).alias("locus"), F.concat(F.lit("c"), text("id"), F.lit(".2")).alias("version"), F.col("seq").alias("origin"), features.alias("features")), path)
    return path


@query(
    "s12_viral_features",
    f"""{VIRAL}, f AS (SELECT id, seq, 0 AS number, '5putr' AS kind, 1 AS start, q AS stop, false AS inverted, '5''UTR' AS annotation FROM v WHERE n >= 24 UNION ALL
 SELECT id, seq, 1, 'gene', q + 1, 3 * q, false, 'g' || id || ' poly protein' FROM v WHERE n >= 24 UNION ALL SELECT id, seq, 2, 'mat_peptide', q + 5, 2 * q, false, 'g' || id || ' poly protein leader' FROM v WHERE n >= 24 UNION ALL
 SELECT id, seq, 3, 'stem_loop', 3 * q, 3 * q + 4, true, 'g' || id || ' poly protein leader loop' FROM v WHERE n >= 24 UNION ALL SELECT id, seq, 4, '3putr', 3 * q + 1, n, false, '3''UTR' FROM v WHERE n >= 24 UNION ALL
 SELECT id, seq, 0, 'gene', 1, n, false, 'g' || id FROM v WHERE n BETWEEN 1 AND 23)
SELECT 'V' || id AS locus, 'c' || id AS contig, number, kind, start, stop, inverted, annotation, md5(CASE WHEN inverted THEN translate(reverse(seq[start:stop]), 'ACGT', 'TGCA') ELSE seq[start:stop] END) AS sum FROM f""",
)
def s12_features(spark, sf_dir):
    return P.viral_features(spark, viral_file(spark, sf_dir)).withColumn("sum", F.md5("seq")).drop("seq")


@query("s12_viral_coding", f"{VIRAL} SELECT 'V' || id AS locus, 0 AS number, 'join(' || (q + 1) || '..' || 2 * q || ',' || 2 * q || '..' || 3 * q || ')' AS location, 1 AS slips, 'poly protein' AS product, md5(seq[q + 1:2 * q] || seq[2 * q:3 * q]) AS sum FROM v WHERE n >= 24")
def s12_coding(spark, sf_dir):
    return P.viral_coding(spark, viral_file(spark, sf_dir)).select("locus", "number", "location", "slips", "product", F.md5("coding").alias("sum"))
