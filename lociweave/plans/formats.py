"""Queries over files: a driver table is written in a format of the field and read again; and small functions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import sequence as S
from ..operators import membership as M
from ..operators.graph import shared_folder, spread
from ..sources import readers as R
from ..sources import writers as W
from .registry import query
from .standin import FEATURES, INTERVALS, MEMBERS, SEQUENCES, features, intervals, members, sequences, table

SEQ = f"WITH {SEQUENCES}"


def fresh(spark) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def text(c: str):
    return F.col(c).cast("string")


@query("s01_genome_list", "SELECT n_name AS genome, n_nationkey AS genome_idx FROM nation")
def s01(spark, sf_dir):
    path = fresh(spark)
    table(spark, sf_dir, "nation").coalesce(1).sortWithinPartitions("n_nationkey").select("n_name").write.text(path)
    return R.genome_list(spark, path)


@query("s02_fasta", f"{SEQ} SELECT CAST(id AS VARCHAR) AS id, md5(seq) AS sum, length(seq) AS len FROM sequences WHERE length(seq) > 0")
def s02(spark, sf_dir):
    path = fresh(spark)
    W.write_fasta(sequences(spark, sf_dir).where("length(seq) > 0").select(text("id").alias("header"), "seq"), path)
    return R.fasta(spark, path).select("id", F.md5("seq").alias("sum"), F.length("seq").alias("len"))


@query("s05_topology", "SELECT 'n' || s_nationkey AS genome, 'c' || s_suppkey AS contig, s_suppkey % 2 = 0 AS is_circular FROM supplier")
def s05(spark, sf_dir):
    path = fresh(spark)
    kind = F.when(F.col("s_suppkey") % 2 == 0, "circular").otherwise("linear")
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.lit("n"), text("s_nationkey")), F.concat(F.lit("c"), text("s_suppkey")), kind)
    W.write_table(rows.toDF("g", "c", "t"), path, header=False)
    return R.topology(spark, path)


@query("s07_tabular_hits", "SELECT 'p' || l_partkey AS qid, 's' || l_suppkey AS sid, count(*) AS n, max(l_quantity) AS pid, max(l_linenumber) AS length, min(l_discount) AS evalue FROM lineitem GROUP BY 1, 2")
def s07(spark, sf_dir):
    path = fresh(spark)
    li = table(spark, sf_dir, "lineitem")
    one = F.lit("1")
    cells = [F.concat(F.lit("p"), text("l_partkey")), F.concat(F.lit("s"), text("l_suppkey")), text("l_quantity"), text("l_linenumber"), one, one, one, one, one, one, text("l_discount"), text("l_tax")]
    li.select(F.concat_ws("\t", *cells)).write.text(path)
    h = R.hits(spark, path).groupBy("qid", "sid")
    return h.agg(F.count(F.lit(1)).alias("n"), F.max("pid").alias("pid"), F.max("length").alias("length"), F.min("evalue").alias("evalue"))


@query("s17_matchtable", f"WITH {MEMBERS} SELECT cluster, 'n' || genome AS genome, 'f' || cluster || '_' || genome AS feat FROM members")
def s17(spark, sf_dir):
    path, names = fresh(spark), [f"n{k}" for k in range(25)]
    m = members(spark, sf_dir).select("cluster", F.concat(F.lit("n"), text("genome")).alias("genome"), F.concat(F.lit("f"), text("cluster"), F.lit("_"), text("genome")).alias("feat"))
    W.matchtable_lines(m, names).write.text(path)
    return R.matchtable(spark, path, names)


@query("s18_adjacency", "SELECT DISTINCT l_partkey % 40 AS c1, CASE WHEN l_linenumber % 2 = 0 THEN 5 ELSE 3 END AS e1, l_suppkey % 40 AS c2, 5 AS e2, l_returnflag AS genome FROM lineitem")
def s18(spark, sf_dir):
    path, names = fresh(spark), ["A", "N", "R"]
    li = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 40).alias("c1"), F.when(F.col("l_linenumber") % 2 == 0, 5).otherwise(3).alias("e1"), (F.col("l_suppkey") % 40).alias("c2"), "l_returnflag")
    g = li.groupBy("c1", "e1", "c2").agg(F.collect_set("l_returnflag").alias("g"))
    bits = [F.when(F.array_contains("g", n), "1").otherwise("0") for n in names]
    g.select(F.concat_ws("\t", F.format_string("(%d_%d,%d_5)", "c1", "e1", "c2"), *bits)).write.text(path)
    return R.adjacency(spark, path, names)


@query("s20_term_mapping", "SELECT 'PF' || p_partkey AS accession, replace(p_brand, '#', '') AS name, 'GO:' || p_size AS term, p_type AS term_name FROM part")
def s20(spark, sf_dir):
    path = fresh(spark)
    line = F.concat(F.lit("Pfam:PF"), text("p_partkey"), F.lit(" "), F.replace("p_brand", F.lit("#"), F.lit("")), F.lit(" > GO:"), F.col("p_type"), F.lit(" ; GO:"), text("p_size"))
    table(spark, sf_dir, "part").select(line).write.text(path)
    return R.term_mapping(spark, path)


@query("s24_mash_table", f"WITH {MEMBERS}, n AS (SELECT genome, count(*) AS n FROM members GROUP BY 1) SELECT 'n' || a.genome AS a, 'n' || b.genome AS b, abs(a.n - b.n) / 10000.0::DOUBLE AS distance, a.n AS shared, b.n AS sketch FROM n a, n b WHERE a.genome < b.genome")
def s24(spark, sf_dir):
    path = fresh(spark)
    n = members(spark, sf_dir).groupBy("genome").agg(F.count(F.lit(1)).alias("n"))
    a, b = n.toDF("ga", "na"), n.toDF("gb", "nb")
    name = lambda c: F.concat(F.lit("n"), text(c))
    rows = a.join(b, F.col("ga") < F.col("gb")).select(name("ga"), name("gb"), (F.abs(F.col("na") - F.col("nb")) / 10000.0), F.lit(0.0), F.concat(text("na"), F.lit("/"), text("nb")))
    W.write_table(rows.toDF(*"abdps"), path, header=False)
    return R.mash_table(spark, path).select("a", "b", "distance", "shared", "sketch")


@query("k04_fasta_by_genome", f"{SEQ} SELECT genome, CAST(count(*) AS BIGINT) AS records, CAST(sum(length(seq)) AS BIGINT) AS letters FROM sequences WHERE length(seq) > 0 GROUP BY 1")
def k04(spark, sf_dir):
    path = fresh(spark)
    W.write_fasta(sequences(spark, sf_dir).where("length(seq) > 0").select("genome", text("id").alias("header"), "seq"), path, by="genome")
    t = spark.read.text(path)  # the folders give the column
    head = F.col("value").startswith(">")
    return t.groupBy("genome").agg(F.sum(head.cast("long")).alias("records"), F.sum(F.when(head, 0).otherwise(F.length("value"))).alias("letters"))


@query("k05_split", "SELECT CASE WHEN l_quantity > 25 THEN 'main' ELSE 'left' END AS part, count(*) AS n, sum(l_orderkey) % 1000003 AS sum FROM lineitem GROUP BY 1")
def k05(spark, sf_dir):
    path = fresh(spark)
    W.write_split(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity"), f"{path}/main", f"{path}/left", "l_quantity > 25")
    one = lambda n: spark.read.parquet(f"{path}/{n}").agg(F.lit(n).alias("part"), F.count(F.lit(1)).alias("n"), (F.sum("l_orderkey") % 1000003).alias("sum"))
    return one("main").union(one("left"))


@query("k06_gff3", f"WITH {INTERVALS} SELECT concat_ws(chr(9), contig, 'orders', 'region', start, stop, '.', CASE WHEN part % 2 = 0 THEN '+' ELSE '-' END, '0', 'ID=' || name) AS value FROM intervals")
def k06(spark, sf_dir):
    i = intervals(spark, sf_dir).withColumns({"orient": F.when(F.col("part") % 2 == 0, 1).otherwise(-1), "contig": text("contig")})
    return W.gff3_lines(i, "orders", "region")


@query("k08_gaf", "SELECT concat_ws(chr(9), 'DB', p_name, p_name, '', 'GO:' || p_size, 'DB_REF', 'IEA', '', p_brand, '', '', 'gene', 'taxon:9', '20200101', 'DB') AS value FROM part")
def k08(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_name").alias("gene"), F.concat(F.lit("GO:"), text("p_size")).alias("term"), F.col("p_brand").alias("aspect"))
    return W.gaf_lines(p, "DB", "20200101", "9")


@query("k09_expression_table", f"WITH {MEMBERS} SELECT cluster, any_value(p_name) AS name, any_value(p_brand) AS role, {', '.join(f'max(CASE WHEN genome = {g} THEN 1 ELSE 0 END) AS g{g}' for g in range(25))} FROM members JOIN part ON p_partkey = cluster GROUP BY cluster")
def k09(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cluster"), F.col("p_partkey").alias("feat"), F.col("p_name").alias("name"), F.col("p_brand").alias("role"))
    return W.expression_table(members(spark, sf_dir), p, list(range(25)))


@query("k10_statistics", f"WITH {MEMBERS}, n AS (SELECT cluster, count(*) AS n FROM members GROUP BY 1), s AS (SELECT count(*) AS c, count(*) FILTER (n * 100 >= 25 * 95) AS core, count(*) FILTER (n = 1) AS one, sum(n) AS m FROM n) SELECT unnest(['clusters', 'core', 'single', 'members', 'mean']) AS name, unnest([c::VARCHAR, core::VARCHAR, one::VARCHAR, m::VARCHAR, printf('%.2f', m / c)]) AS value FROM s")
def k10(spark, sf_dir):
    return W.statistics_report(members(spark, sf_dir), 25)


@query("k12_synteny_table", f"WITH {FEATURES} SELECT genome, contig, count(*) AS n, min(pos) AS first FROM features GROUP BY 1, 2")
def k12(spark, sf_dir):
    path = fresh(spark)
    W.write_synteny(features(spark, sf_dir).withColumnRenamed("pos", "start"), path)
    t = spark.read.parquet(path).groupBy(F.col("genome").cast("long").alias("genome"), "contig")
    return t.agg(F.count(F.lit(1)).alias("n"), F.min("start").alias("first"))


@query("f09_assemblies", "SELECT c_custkey AS accession, c_name AS name FROM customer WHERE c_nationkey % 4 <> 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY') AND contains(c_name, '1') AND c_acctbal >= 1000 AND c_nationkey <= 20 AND c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def f09(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("accession"), F.col("c_name").alias("name"), F.when(F.col("c_nationkey") % 4 != 0, "latest").otherwise("replaced").alias("version"), F.col("c_mktsegment").alias("level"), F.col("c_acctbal").alias("n50"), F.col("c_nationkey").alias("contigs"))
    return M.assemblies(c, "1", table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("accession")), 1000, 20, ("BUILDING", "MACHINERY")).select("accession", "name")


@query("j19_genomes_left", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def j19(spark, sf_dir):
    gone = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey").join(gone, "o_orderkey", "left_anti")


@query("t09_combinations", "SELECT a.n_nationkey || '-' || b.n_nationkey || '-' || c.n_nationkey AS combo, unnest([1, 2, 3]) AS place, unnest([a.n_nationkey, b.n_nationkey, c.n_nationkey]) AS genome FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey JOIN nation c ON b.n_nationkey < c.n_nationkey")
def t09(spark, sf_dir):
    return M.combinations(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("genome")), 3)


@query("t09_sampled_combinations")
def t09s(spark, sf_dir):
    return M.combinations(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("genome")), 4, sample=250)


@query("x07_canonical_kmers", f"{SEQ}, k AS (SELECT id, unnest(list_transform(range(1, length(seq) - 6), lambda i: seq[i:i + 7])) AS km FROM sequences WHERE length(seq) >= 8) SELECT id, count(*) AS n, count(DISTINCT least(km, reverse(translate(km, 'ACGT', 'TGCA')))) AS kinds FROM k GROUP BY 1")
def x07(spark, sf_dir):
    seq = sequences(spark, sf_dir)
    k = seq.repartition(spread(seq), "id").select("id", F.explode(S.kmers(F.col("seq"), 8)).alias("k"))  # sequences are shuffled, not their k-mers
    return k.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(S.canonical(F.col("k"))).alias("kinds"))


@query("x09_sanitized_headers", "SELECT item_id, regexp_replace(text, '[^A-Za-z0-9_.|-]+', '_', 'g') AS header FROM benchmark")
def x09(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", S.sanitized_header(F.col("text")).alias("header"))


@query("x10_soft_mask", f"{SEQ} SELECT id, upper(seq[1:5]) || lower(seq[6:10]) || upper(seq[11:15]) || lower(seq[16:]) AS masked FROM sequences")
def x10(spark, sf_dir):
    return sequences(spark, sf_dir).select("id", S.soft_mask(F.col("seq"), F.array(F.lit(1), F.lit(11)), 5).alias("masked"))


@query("x11_locus_prefixes", "SELECT regexp_extract(replace(p_brand, '#', '_') || '_' || p_partkey, '^(.*?)_?[0-9]+$', 1) AS prefix, count(*) AS n FROM part GROUP BY 1")
def x11(spark, sf_dir):
    locus = F.concat(F.replace("p_brand", F.lit("#"), F.lit("_")), F.lit("_"), text("p_partkey"))
    return table(spark, sf_dir, "part").groupBy(S.locus_prefix(locus).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


@query("x20_header_fields", "SELECT doc_id, lang AS second, source AS last FROM documents")
def x20(spark, sf_dir):
    head = F.concat(text("doc_id"), F.lit("|"), "lang", F.lit("|"), "source")
    return table(spark, sf_dir, "documents").select("doc_id", S.header_field(head, 2).alias("second"), S.header_field(head, 3).alias("last"))


@query("x24_nucleotide_snps", f"{SEQ}, s AS (SELECT id, seq[id % 30 + 1:id % 30 + 1] AS c FROM sequences) SELECT id, CASE WHEN c = 'G' THEN 'mutant' WHEN c = 'A' THEN 'wild type' WHEN c <> '' THEN 'other' END AS state FROM s")
def x24(spark, sf_dir):
    spec = F.concat(F.lit("A"), (F.col("id") % 30 + 1).cast("string"), F.lit("G"))
    return sequences(spark, sf_dir).select("id", S.nucleotide_snp(F.col("seq"), spec).alias("state"))


@query("x29_validators", f"SELECT doc_id, regexp_full_match('>' || source || ' ' || lang, '>[!-~]+( .*)?') AS header, regexp_full_match(lang, '[ACGTURYSWKMBDHVNacgturyswkmbdhvn-]+') AS nucleotides, regexp_full_match(source, '[A-IK-NP-Z*a-ik-np-z-]+') AS protein FROM documents")
def x29(spark, sf_dir):
    head = F.concat(F.lit(">"), "source", F.lit(" "), "lang")
    return table(spark, sf_dir, "documents").select("doc_id", S.valid_header(head).alias("header"), S.valid_sequence(F.col("lang")).alias("nucleotides"), S.valid_sequence(F.col("source"), True).alias("protein"))


@query("x30_date_strings", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS sql, strftime(o_orderdate, '%Y%m%d.%H%M%S') AS log FROM orders")
def x30(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", S.date_strings(F.col("o_orderdate")).alias("d")).select("o_orderkey", "d.*")


@query("x13_pairwise_distance", "WITH e AS (SELECT item_id AS id, unnest(range(1, length(text) + 1)) AS pos, unnest(string_split(upper(regexp_replace(text, '[^a-zA-Z]', '-', 'g')), '')) AS base FROM benchmark) SELECT a.id AS id, round(1 - sum(CASE WHEN a.base = b.base THEN 1 ELSE 0 END) / count(*), 9) AS distance FROM e a JOIN e b ON b.id = a.id + 1 AND a.pos = b.pos WHERE a.base NOT IN ('-', 'N') AND b.base NOT IN ('-', 'N') GROUP BY 1")
def x13(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.regexp_replace("text", "[^a-zA-Z]", "-").alias("s1"))
    p = b.join(b.select((F.col("id") - 1).alias("id"), F.col("s1").alias("s2")), "id")
    return p.select("id", F.round(S.distance(F.col("s1"), F.col("s2")), 9).alias("distance"))
