"""Further queries over files: a driver table is written in a format of the field and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import trees as T
from ..sources import readers as R
from ..sources import writers as W
from .formats import SEQ, fresh, text
from .records import viral_file
from .registry import query
from .standin import INTERVALS, MEMBERS, intervals, members, sequences, table


def written(df, path: str, *columns, **options) -> str:
    """Lines of the columns, separated by tabs."""
    df.select(F.concat_ws("\t", *columns).alias("value")).write.options(**options).text(path)
    return path


@query("s03_fasta_by_id", f"{SEQ} SELECT CAST(id AS VARCHAR) AS id, md5(seq) AS sum FROM sequences WHERE length(seq) > 0 AND id IN (SELECT item_id FROM benchmark)")
def s03(spark, sf_dir):
    path = fresh(spark)
    W.write_fasta(sequences(spark, sf_dir).where("length(seq) > 0").select(text("id").alias("header"), "seq"), path)
    wanted = table(spark, sf_dir, "benchmark").select(text("item_id").alias("id"))
    return R.fasta(spark, path).join(wanted, "id", "left_semi").select("id", F.md5("seq").alias("sum"))


PROBLEMS = """a AS (SELECT 'f' || l_partkey || '_' || l_suppkey AS feat, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey % 50 END AS end5, l_suppkey % 50 AS end3 FROM lineitem),
n AS (SELECT feat, count(*) AS n FROM a GROUP BY 1)"""


@query("s04_attribute_problems", f"""WITH {PROBLEMS} SELECT DISTINCT feat, 'no place' AS problem FROM a WHERE end5 IS NULL UNION SELECT feat, 'no extent' FROM a WHERE end5 = end3 UNION SELECT feat, 'listed twice' FROM n WHERE n > 1""")
def s04(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    feat = F.concat(F.lit("f"), text("l_partkey"), F.lit("_"), text("l_suppkey"))
    end5 = F.when(F.col("l_linenumber") == 7, "").otherwise((F.col("l_orderkey") % 50).cast("string"))
    path = written(li, fresh(spark), F.lit("c1"), feat, end5, (F.col("l_suppkey") % 50).cast("string"), F.lit("name"), F.lit("g1"))
    return R.attribute_problems(R.attributes(spark, path))


@query("s07_filtered_hits", """WITH h AS (SELECT l_partkey, l_suppkey, l_orderkey, l_quantity AS pid, l_linenumber AS qstart, l_linenumber + l_quantity AS qend, p_size + 20 AS qlen FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT 'p' || l_partkey AS qid, 's' || l_suppkey AS sid, CAST(pid AS DOUBLE) AS pid, count(*) AS n, round((qend - qstart + 1) / qlen, 9) AS coverage FROM h WHERE pid >= 30 AND (qend - qstart + 1) / qlen >= 0.6::DOUBLE GROUP BY ALL""")
def s07f(spark, sf_dir):
    li, one = table(spark, sf_dir, "lineitem"), F.lit("1")
    n = F.col("l_quantity").cast("int")
    cells = [F.concat(F.lit("p"), text("l_partkey")), F.concat(F.lit("s"), text("l_suppkey")), text("l_quantity"), n.cast("string"), one, one, text("l_linenumber"), (F.col("l_linenumber") + n).cast("string"), one, one, text("l_discount"), text("l_tax")]
    lengths = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), text("p_partkey")).alias("qid"), (F.col("p_size") + 20).alias("qlen"))
    h = R.filtered_hits(spark, written(li, fresh(spark), *cells), 30, 0.6, lengths)
    return h.groupBy("qid", "sid", "pid", "coverage").agg(F.count(F.lit(1)).alias("n"))


#: Hits in one file of search results, about.
FILE_HITS = 40_000


@query("s09_search_xml", "SELECT 'p' || l_partkey AS query, 's' || l_suppkey AS hit, l_discount AS evalue, l_quantity AS bits, CAST(l_linenumber AS INTEGER) AS identity FROM lineitem")
def s09(spark, sf_dir):
    tag = lambda n, v: F.concat(F.lit(f"<{n}>"), v.cast("string"), F.lit(f"</{n}>"))
    li = table(spark, sf_dir, "lineitem")
    hsp = F.concat(F.lit("<Hit_hsps><Hsp>"), tag("Hsp_bit-score", F.col("l_quantity")), tag("Hsp_evalue", F.col("l_discount")), tag("Hsp_identity", F.col("l_linenumber")), F.lit("</Hsp></Hit_hsps>"))
    hit = F.concat(F.lit("<Hit>"), tag("Hit_def", F.concat(F.lit("s"), F.col("l_suppkey"))), hsp, F.lit("</Hit>"))
    files = max(16, -(-li.count() // FILE_HITS))  # a file is one document and a row; their number follows the table's, so each stays small
    q = li.groupBy("l_partkey").agg(F.array_join(F.collect_list(hit), "").alias("hits"))
    value = F.concat(F.lit("<Iteration>"), tag("Iteration_query-def", F.concat(F.lit("p"), F.col("l_partkey"))), F.lit("<Iteration_hits>"), F.col("hits"), F.lit("</Iteration_hits></Iteration>"))
    root = F.concat(F.lit("<R>"), F.array_join(F.collect_list("value"), ""), F.lit("</R>")).alias("value")
    path = fresh(spark)
    q.select(F.pmod(F.xxhash64("l_partkey"), F.lit(files)).alias("k"), value.alias("value")).groupBy("k").agg(root).write.partitionBy("k").text(path)
    return R.search_xml(spark, path)


@query("s10_flat_file_features", f"""{SEQ}, v AS (SELECT id, length(seq) AS n, length(seq) // 4 AS q FROM sequences) SELECT 'V' || id || '.1' AS locus, 'CDS' AS kind, q + 1 AS end5, 3 * q AS end3, 'poly protein' AS product FROM v WHERE n >= 24
UNION ALL SELECT 'V' || id || '.1', 'gene', CASE WHEN n >= 24 THEN q + 1 ELSE 1 END, CASE WHEN n >= 24 THEN 3 * q ELSE n END, NULL FROM v WHERE n > 0""")
def s10(spark, sf_dir):
    f = R.genbank(spark, viral_file(spark, sf_dir)).where("kind in ('CDS', 'gene')")
    return f.select("locus", "kind", "end5", "end3", "product")


@query("s13_gff", f"WITH {INTERVALS} SELECT CAST(contig AS VARCHAR) AS contig, start, stop, CASE WHEN part % 2 = 0 THEN '+' ELSE '-' END AS strand, CAST(name AS VARCHAR) AS name FROM intervals")
def s13(spark, sf_dir):
    path = fresh(spark)
    i = intervals(spark, sf_dir).withColumn("orient", F.when(F.col("part") % 2 == 0, 1).otherwise(-1)).withColumn("contig", text("contig"))
    W.gff3_lines(i, "orders", "exon").write.text(path)
    return R.gff_exons(spark, path).select("contig", "start", "stop", "strand", F.col("attributes")["ID"].alias("name"))


def fastq_file(spark, sf_dir) -> str:
    s = sequences(spark, sf_dir).where("length(seq) > 0")
    quality = F.translate("seq", "ACGT", "@I+5")  # a quality may begin like a head
    value = F.concat(F.lit("@r"), text("id"), F.lit(" x\n"), F.col("seq"), F.lit("\n+\n"), quality)
    path = fresh(spark)
    s.select(value.alias("value")).write.text(path)
    return path


READS = "SELECT 'r' || id AS id, md5(seq) AS sum, md5(translate(seq, 'ACGT', '@I+5')) AS quality FROM sequences WHERE length(seq) > 0"


@query("s14_fastq", f"{SEQ} {READS}")
def s14(spark, sf_dir):
    """Split every 64 kB, so that records lie on both sides of splits."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    path = fastq_file(spark, sf_dir)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        from ..operators.graph import settle

        return settle(R.fastq(spark, path).select("id", F.md5("seq").alias("sum"), F.md5("quality").alias("quality")))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@query("s15_sequence_records", f"{SEQ} {READS} UNION ALL SELECT CAST(id AS VARCHAR), md5(seq), NULL FROM sequences WHERE length(seq) > 0")
def s15(spark, sf_dir):
    """Files of either kind in one folder."""
    path = fastq_file(spark, sf_dir)
    W.write_fasta(sequences(spark, sf_dir).where("length(seq) > 0").select(text("id").alias("header"), "seq"), f"{path}-fasta")
    return R.sequence_records(spark, f"{path}*").select("id", F.md5("seq").alias("sum"), F.md5("quality").alias("quality"))


@query("s19_hmm_table", "SELECT p_name AS target, 'PF' || p_partkey AS accession, replace(p_brand, '#', '') AS query, CAST(p_size AS DOUBLE) AS evalue, p_retailprice AS score, p_type AS description FROM part")
def s19(spark, sf_dir):
    p, blank = table(spark, sf_dir, "part"), F.lit("-")
    name = F.regexp_replace("p_name", r"\s", "_")
    cells = [name, F.concat(F.lit("PF"), text("p_partkey")), F.regexp_replace("p_brand", "#", ""), blank, text("p_size"), text("p_retailprice"), *[blank] * 12, F.col("p_type")]
    path = fresh(spark)
    p.select(F.concat_ws("  ", *cells).alias("value")).write.text(path)
    h = R.hmm_table(spark, path)
    return h.withColumn("target", F.regexp_replace("target", "_", " ")).select("target", "accession", "query", "evalue", "score", "description")


@query("s19_hmm_domains", "SELECT 'p' || l_partkey AS target, 's' || l_suppkey AS query, CAST(l_linenumber AS INTEGER) AS domain, l_discount AS evalue, l_tax AS score, 1 AS hmm_start, CAST(l_quantity AS INTEGER) AS hmm_stop, CAST(l_linenumber AS INTEGER) AS start, CAST(l_linenumber + l_quantity AS INTEGER) AS stop FROM lineitem")
def s19d(spark, sf_dir):
    li, x = table(spark, sf_dir, "lineitem"), F.lit("0")
    n = F.col("l_quantity").cast("int")
    cells = [F.concat(F.lit("p"), text("l_partkey")), x, x, F.concat(F.lit("s"), text("l_suppkey")), x, x, x, x, x, text("l_linenumber"), x, x, text("l_discount"), text("l_tax"), x, F.lit("1"), n.cast("string"), text("l_linenumber"), (F.col("l_linenumber") + n).cast("string"), x, x, x, F.lit("some words")]
    path = fresh(spark)
    li.select(F.concat_ws(" ", *cells).alias("value")).write.text(path)
    return R.hmm_domains(spark, path)


@query("s21_hierarchy", "SELECT 1 AS level, CAST(n_regionkey AS INTEGER) AS batch, 'L1B' || n_regionkey AS ref, n_name AS part FROM nation UNION ALL SELECT 2, 1, 'L2B1', 'L1B' || r_regionkey FROM region")
def s21(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    one = n.groupBy("n_regionkey").agg(F.array_join(F.collect_list("n_name"), ", ").alias("parts")).select(F.concat(F.lit("L1B"), text("n_regionkey"), F.lit("("), F.col("parts"), F.lit(")")).alias("value"))
    two = r.agg(F.array_join(F.collect_list(F.concat(F.lit("L1B"), text("r_regionkey"))), ",").alias("parts")).select(F.concat(F.lit("L2B1("), F.col("parts"), F.lit(")")).alias("value"))
    path = fresh(spark)
    one.union(two).write.text(path)
    return R.hierarchy(spark, path)


@query("s22_groupings", "SELECT c_name AS genome, c_mktsegment AS grp, 'n' || c_nationkey AS label, 'x' AS short FROM customer")
def s22(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    path = written(c, fresh(spark), "c_name", "c_mktsegment", F.concat(F.lit("n"), text("c_nationkey")), F.lit("x"))
    return R.groupings(spark, path, c.select(F.col("c_name").alias("genome")))


@query("s23_distance_matrix", "SELECT a.n_name AS a, b.n_name AS b, abs(a.n_nationkey - b.n_nationkey) / 4.0::DOUBLE AS distance FROM nation a JOIN nation b ON a.n_nationkey <> b.n_nationkey")
def s23(spark, sf_dir):
    """The lower triangle of a matrix of nations."""
    names = [r["n_name"] for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").collect()]
    n = table(spark, sf_dir, "nation").select("n_name", "n_nationkey")
    cells = [F.when(F.col("n_nationkey") >= k, (F.abs(F.col("n_nationkey") - k) / 4).cast("string")) for k in range(len(names))]
    path = fresh(spark)
    n.coalesce(1).select("n_name", *(c.alias(x) for c, x in zip(cells, names, strict=True))).write.csv(path, sep="\t", header=True)
    return R.distance_matrix(spark, path)


@query("s27_compressed_fasta", f"{SEQ} SELECT CAST(id AS VARCHAR) AS id, md5(seq) AS sum FROM sequences")
def s27(spark, sf_dir):
    path = fresh(spark)
    W.fasta_lines(sequences(spark, sf_dir).select(text("id").alias("header"), "seq")).write.option("compression", "gzip").text(path)
    return R.fasta(spark, path).select("id", F.md5("seq").alias("sum"))


@query("s28_resource_logs", "SELECT n_nationkey + 0.5::DOUBLE + n_regionkey AS cpu_s, n_nationkey * 2048 / 1000.0::DOUBLE AS max_rss_mb FROM nation")
def s28(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    rows = [F.concat(F.lit("User time (seconds): "), (F.col("n_nationkey") + 0.5).cast("string")), F.concat(F.lit("System time (seconds): "), text("n_regionkey")), F.concat(F.lit("Maximum resident set size (kbytes): "), (F.col("n_nationkey") * 2048).cast("string"))]
    path = fresh(spark)
    n.select("n_nationkey", F.concat_ws("\n", *rows).alias("value")).write.partitionBy("n_nationkey").text(path)
    return R.resource_logs(spark, path).select("cpu_s", "max_rss_mb")


@query("s16_model_database", "SELECT CAST(p_partkey AS VARCHAR) AS model_id, p_name AS name, p_type AS type FROM part")
def s16(spark, sf_dir):
    """An object for each brand; a file is one object."""
    entry = F.concat(F.lit('"'), text("p_partkey"), F.lit('": '), F.to_json(F.struct(F.col("p_name").alias("model_name"), F.col("p_type").alias("model_type"))))
    b = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_join(F.collect_list(entry), ", ").alias("e"))
    path = fresh(spark)
    b.select("p_brand", F.concat(F.lit('{"_version": "3", '), F.col("e"), F.lit("}")).alias("value")).write.partitionBy("p_brand").text(path)
    return R.model_database(spark, path).drop("record")


@query("s29_newick", "SELECT CAST(o_custkey AS BIGINT) AS tree, 'o' || o_orderkey AS name, o_orderkey % 100 / 4.0::DOUBLE AS length FROM orders")
def s29(spark, sf_dir):
    """A tree for each customer, with the orders as leaves."""
    leaf = F.concat(F.lit("o"), text("o_orderkey"), F.lit(":"), (F.col("o_orderkey") % 100 / 4).cast("string"))
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("tree")).agg(F.array_join(F.collect_list(leaf), ",").alias("leaves"))
    path = written(o, fresh(spark), text("tree"), F.concat(F.lit("("), F.col("leaves"), F.lit(")root;")))
    t = spark.read.csv(path, sep="\t", schema="tree long, text string", quote="")
    return T.newick_table(t).where("name <> 'root'").select("tree", "name", "length")


@query(
    "k01_member_tables",
    f"""WITH {MEMBERS}, f AS (SELECT cluster, genome, 'f' || cluster || '_' || genome AS feat, 'h' || cluster % 7 AS header, CAST(50 + (cluster * 7 + genome * 3) % 51 AS DOUBLE) AS identity, (cluster + genome) % 10 / 10.0::DOUBLE AS ratio, genome = min(genome) OVER (PARTITION BY cluster) AS first, min(genome) OVER (PARTITION BY cluster) AS q FROM members),
g AS (SELECT c.cluster, c.q, n_nationkey AS genome, f.* EXCLUDE (cluster, genome, q) FROM (SELECT DISTINCT cluster, q FROM f) c CROSS JOIN nation LEFT JOIN f ON f.cluster = c.cluster AND f.genome = n_nationkey),
l AS (SELECT cluster, q, string_agg(CASE WHEN feat IS NULL THEN '' WHEN first THEN feat ELSE feat || ' (' || printf('%5.2f', identity) || '%)' END, chr(9) ORDER BY genome) AS identity,
 string_agg(CASE WHEN genome = 0 THEN feat || chr(9) || header ELSE coalesce(printf('%5.2f', identity), '') END, chr(9) ORDER BY genome) AS id, string_agg(coalesce(feat || ' [' || header || ']', ''), chr(9) ORDER BY genome) AS hits,
 string_agg(CASE WHEN genome = 0 THEN feat || chr(9) || header ELSE coalesce(printf('%2.2f', 100 - 99 * ratio), '100.00') END, chr(9) ORDER BY genome) AS micro, string_agg(CASE WHEN genome = 0 THEN feat || chr(9) || header ELSE coalesce(CAST(ratio AS VARCHAR), '0') END, chr(9) ORDER BY genome) AS ratio FROM g GROUP BY 1, 2)
SELECT cluster, form, cluster || chr(9) || value AS value FROM (SELECT cluster, 'identity' AS form, identity AS value FROM l UNION ALL SELECT cluster, 'id', id FROM l WHERE q = 0 UNION ALL SELECT cluster, 'hits', hits FROM l WHERE q = 0 UNION ALL SELECT cluster, 'micro', micro FROM l WHERE q = 0 UNION ALL SELECT cluster, 'ratio', ratio FROM l WHERE q = 0)""",
)
def k01_forms(spark, sf_dir):
    c, g = F.col("cluster"), F.col("genome")
    m = members(spark, sf_dir).select("cluster", "genome", F.concat(F.lit("f"), text("cluster"), F.lit("_"), text("genome")).alias("feat"), F.concat(F.lit("h"), (c % 7).cast("string")).alias("header"), (50 + (c * 7 + g * 3) % 51).cast("double").alias("identity"), ((c + g) % 10 / 10).alias("ratio"))
    return W.member_tables(m, list(range(25)))
