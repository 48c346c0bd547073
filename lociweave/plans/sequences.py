"""Queries over sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequence as S
from .registry import query
from .standin import SEQUENCES, sequences, table

WITH = f"WITH {SEQUENCES}"
RC = "reverse(translate({}, 'ACGT', 'TGCA'))"
KMERS = f"""{WITH}, k AS (SELECT genome, id, unnest(list_transform(range(1, length(seq) - 4), lambda i: seq[i:i + 5])) AS km FROM sequences WHERE length(seq) >= 6), c AS (SELECT genome, least(km, {RC.format("km")}) AS kmer, count(*) AS n FROM k GROUP BY 1, 2)"""


def rows(spark, sf_dir):
    """Aligned rows of six for each group of benchmark items: aln, id, seq, e as gaps; rows end where their text does."""
    b = table(spark, sf_dir, "benchmark")
    return b.select((F.col("item_id") % 7).alias("aln"), F.col("item_id").alias("id"), F.upper(F.regexp_replace(F.translate("text", "eE \n", "--  "), "[^a-zA-Z-]", "")).alias("seq"))


ROWS = "rows AS (SELECT item_id % 7 AS aln, item_id AS id, upper(regexp_replace(translate(text, 'eE' || chr(32) || chr(10), '--' || chr(32) || chr(32)), '[^a-zA-Z-]', '', 'g')) AS seq FROM benchmark)"
COLUMNS = f"WITH {ROWS}, e AS (SELECT aln, id, unnest(range(1, length(seq) + 1)) AS pos, unnest(string_split(seq, '')) AS base FROM rows)"


@query("x01_reverse_complement", f"{WITH} SELECT id, {RC.format('seq')} AS rc FROM sequences")
def x01(spark, sf_dir):
    return sequences(spark, sf_dir).select("id", S.reverse_complement(F.col("seq")).alias("rc"))


@query("x02_reverse_complement_iupac", "SELECT item_id, reverse(translate(text, 'ACGTURYSWKMBDHVNacgturyswkmbdhvn', 'TGCAAYRSWMKVHDBNtgcaayrswmkvhdbn')) AS rc FROM benchmark")
def x02(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", S.reverse_complement_iupac(F.col("text")).alias("rc"))


@query("x03_subsequence", f"{WITH} SELECT id, CASE WHEN id % 2 = 0 THEN seq[3:12] ELSE {RC.format('seq[3:12]')} END AS part, CASE WHEN seq = '' THEN '' ELSE substr(repeat(seq, 12), ((length(seq) - 6) % length(seq) + length(seq)) % length(seq) + 1, 10) END AS circular FROM sequences")
def x03(spark, sf_dir):
    s = sequences(spark, sf_dir)
    a, b = F.when(F.col("id") % 2 == 0, 3).otherwise(12), F.when(F.col("id") % 2 == 0, 12).otherwise(3)
    return s.select("id", S.subsequence(F.col("seq"), a, b).alias("part"), S.circular_subsequence(F.col("seq"), F.length("seq") - 5, F.lit(10)).alias("circular"))


@query("x04_clean_and_mask", "SELECT item_id, regexp_replace(text, '[-.]', '', 'g') AS ungapped, regexp_replace(text, '[^a-zA-Z]', '', 'g') AS clean, upper(regexp_replace(text, '[^ACGTacgt]', 'N', 'g')) AS masked FROM benchmark")
def x04(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "benchmark").select("item_id", S.ungap(t).alias("ungapped"), S.clean(t).alias("clean"), S.mask_ambiguous(t).alias("masked"))


CODON = "list_transform(range(0, CAST(floor((length({0}) - {1}) / 3) AS BIGINT)), lambda i: {0}[i * 3 + 1 + {1}:i * 3 + 3 + {1}])"
OPEN = "NOT list_has_any({}, ['TAA', 'TAG', 'TGA'])"


@query("x06_open_frames", f"{WITH}, r AS (SELECT id, seq, {RC.format('seq')} AS rc FROM sequences) SELECT id, {', '.join(f'{OPEN.format(CODON.format(x, f))} AS open_{x}_{f}' for x in ('seq', 'rc') for f in range(3))} FROM r")
def x06(spark, sf_dir):
    s = sequences(spark, sf_dir).select("id", S.open_frames(F.col("seq")).alias("o"))
    return s.select("id", *(F.get("o", F.lit(k)).alias(n) for k, n in enumerate([f"open_{x}_{f}" for x in ("seq", "rc") for f in range(3)])))


@query("x25_translation", f"""{WITH} SELECT id, array_to_string(list_transform({CODON.format('seq', 0)}, lambda c: '{S.TABLE_11}'[(instr('TCAG', c[1:1]) - 1) * 16 + (instr('TCAG', c[2:2]) - 1) * 4 + instr('TCAG', c[3:3]):(instr('TCAG', c[1:1]) - 1) * 16 + (instr('TCAG', c[2:2]) - 1) * 4 + instr('TCAG', c[3:3])]), '') AS protein FROM sequences""")
def x25(spark, sf_dir):
    return sequences(spark, sf_dir).select("id", S.translate(F.col("seq")).alias("protein"))


@query("a22_kmer_counts", f"{KMERS} SELECT * FROM c")
def a22(spark, sf_dir):
    return S.kmer_counts(sequences(spark, sf_dir), 6)


@query("x08_anchor_kmers", f"""{WITH}, k AS (SELECT genome, unnest(list_transform(range(1, length(seq) - 10), lambda i: seq[i:i + 11])) AS km FROM sequences WHERE length(seq) >= 12), c AS (SELECT genome, least(km, {RC.format("km")}) AS kmer, count(*) AS n FROM k GROUP BY 1, 2)
SELECT kmer, count(*) AS n_genomes FROM c GROUP BY kmer HAVING max(n) = 1 AND count(*) >= 2""")
def x08(spark, sf_dir):
    return S.anchor_kmers(sequences(spark, sf_dir), 12, 2)


@query("k03_wrapped_fasta", f"""{WITH} SELECT '>' || id || chr(10) || array_to_string(list_transform(range(0, CAST(ceil(length(seq) / 60) AS BIGINT)), lambda i: seq[i * 60 + 1:i * 60 + 60]), chr(10)) AS record FROM sequences""")
def k03(spark, sf_dir):
    return sequences(spark, sf_dir).select(F.concat(F.lit(">"), F.col("id").cast("string"), F.lit("\n"), S.wrap(F.col("seq"))).alias("record"))


@query("x17_alignment_columns", f"{COLUMNS} SELECT aln, pos, base, count(*) AS n FROM e GROUP BY ALL")
def x17(spark, sf_dir):
    return S.alignment_columns(rows(spark, sf_dir))


@query("a37_unique_alleles", f"{COLUMNS}, u AS (SELECT aln, pos, base, min(id) AS id FROM e GROUP BY aln, pos, base HAVING count(*) = 1) SELECT aln, id, count(*) AS n FROM u GROUP BY aln, id")
def a37(spark, sf_dir):
    return S.unique_alleles(rows(spark, sf_dir))


PAIR = f"{COLUMNS}, p AS (SELECT a.aln, a.id AS id1, b.id AS id2, sum(CASE WHEN a.base = b.base THEN 1 ELSE 0 END) AS same, count(*) AS n FROM e a JOIN e b ON a.aln = b.aln AND a.pos = b.pos AND a.id < b.id WHERE a.base <> '-' AND b.base <> '-' GROUP BY 1, 2, 3)"


def _pairs(spark, sf_dir):
    r = rows(spark, sf_dir)
    a, b = r.select("aln", F.col("id").alias("id1"), F.col("seq").alias("s1")), r.select("aln", F.col("id").alias("id2"), F.col("seq").alias("s2"))
    return a.join(b, "aln").where("id1 < id2")


@query("x12_pairwise_identity", f"{PAIR} SELECT aln, id1, id2, round(same / n, 9) AS identity FROM p")
def x12(spark, sf_dir):
    p = _pairs(spark, sf_dir).select("aln", "id1", "id2", F.round(S.identity(F.col("s1"), F.col("s2")), 9).alias("identity"))
    return p.where("identity is not null")


@query("a21_whole_genome_identity", f"{PAIR} SELECT id1 % 3 AS g1, id2 % 3 AS g2, round(sum(same) / sum(n) * 100, 9) AS ani FROM p GROUP BY 1, 2")
def a21(spark, sf_dir):
    m = S._matches(F.col("s1"), F.col("s2"), "-")
    p = _pairs(spark, sf_dir).select((F.col("id1") % 3).alias("g1"), (F.col("id2") % 3).alias("g2"), m.alias("m"))
    return p.groupBy("g1", "g2").agg(F.round(F.sum(F.aggregate("m", F.lit(0), lambda s, x: s + x)) / F.sum(F.size("m")) * 100, 9).alias("ani"))


@query("a25_distance_summary", f"{PAIR}, d AS (SELECT aln, 1 - same / n AS x FROM p) SELECT aln, round(avg(x), 9) AS mean, round(median(x), 9) AS median, round(min(x), 9) AS least, round(max(x), 9) AS most, round(coalesce(stddev_samp(x), 0), 9) AS sd, round(quantile_cont(x, 0.05), 9) AS q05, round(quantile_cont(x, 0.95), 9) AS q95 FROM d GROUP BY aln")
def a25(spark, sf_dir):
    d = _pairs(spark, sf_dir).select("aln", (1 - S.identity(F.col("s1"), F.col("s2"))).alias("x")).where("x is not null")
    r = lambda c, n: F.round(c, 9).alias(n)
    return d.groupBy("aln").agg(r(F.avg("x"), "mean"), r(F.median("x"), "median"), r(F.min("x"), "least"), r(F.max("x"), "most"), r(F.coalesce(F.stddev_samp("x"), F.lit(0)), "sd"), r(F.percentile("x", 0.05), "q05"), r(F.percentile("x", 0.95), "q95"))


@query("s11_coordinates", """WITH l AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'complement(join(' || o_custkey || '..' || o_custkey + 9 || ',' || o_custkey + 50 || '..' || o_custkey + 90 || '))' ELSE o_custkey || '..' || o_custkey + 30 END AS loc FROM orders),
n AS (SELECT id, loc, list_transform(regexp_extract_all(loc, '[0-9]+'), lambda x: CAST(x AS BIGINT)) AS n FROM l) SELECT id, CASE WHEN contains(loc, 'complement') THEN list_max(n) ELSE list_min(n) END AS end5, CASE WHEN contains(loc, 'complement') THEN list_min(n) ELSE list_max(n) END AS end3 FROM n""")
def s11(spark, sf_dir):
    k = F.col("o_custkey")
    t = lambda c: c.cast("string")
    loc = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("complement(join("), t(k), F.lit(".."), t(k + 9), F.lit(","), t(k + 50), F.lit(".."), t(k + 90), F.lit("))"))).otherwise(F.concat(t(k), F.lit(".."), t(k + 30)))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), S.coordinates(loc).alias("c"))
    return o.select("id", "c.end5", "c.end3")


@query("x22_snp_specs", "WITH s AS (SELECT l_partkey AS id, l_returnflag || l_linenumber || l_linestatus AS spec, upper(l_returnflag || l_linestatus || 'RANFO') AS protein FROM lineitem) SELECT id, spec, spec[1:1] AS original, CAST(spec[2:length(spec) - 1] AS INTEGER) AS position, spec[length(spec):] AS change, protein[CAST(spec[2:length(spec) - 1] AS INTEGER):CAST(spec[2:length(spec) - 1] AS INTEGER)] = spec[length(spec):] AS present FROM s")
def x22(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    spec = F.concat("l_returnflag", F.col("l_linenumber").cast("string"), "l_linestatus")
    d = li.select(F.col("l_partkey").alias("id"), spec.alias("spec"), F.upper(F.concat("l_returnflag", "l_linestatus", F.lit("RANFO"))).alias("protein"))
    return d.select("id", "spec", S.snp(F.col("spec")).alias("s"), S.has_snp(F.col("protein"), F.col("spec")).alias("present")).select("id", "spec", "s.*", "present")


@query("x26_header_md5", "SELECT doc_id, md5(source || '|' || lang || '|' || doc_id) AS h, lang AS field FROM documents")
def x26(spark, sf_dir):
    head = F.concat_ws("|", "source", "lang", F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(head).alias("h"), S.header_field(head, 2).alias("field"))


@query("x21_dash_offset", f"WITH {ROWS} SELECT id, length(seq[1:20]) - length(replace(seq[1:20], '-', '')) AS n FROM rows")
def x21(spark, sf_dir):
    return rows(spark, sf_dir).select("id", S.dash_offset(F.col("seq"), F.lit(20)).alias("n"))


@query("t06_longest_sequences", f"{WITH} SELECT id, genome, length(seq) AS n FROM (SELECT *, rank() OVER (PARTITION BY genome ORDER BY length(seq) DESC) AS r FROM sequences) WHERE r = 1")
def t06(spark, sf_dir):
    from pyspark.sql import Window

    s = sequences(spark, sf_dir).withColumn("n", F.length("seq"))
    return s.withColumn("r", F.rank().over(Window.partitionBy("genome").orderBy(F.col("n").desc()))).where("r = 1").select("id", "genome", "n")


@query("mash_sketch_sizes")
def mash(spark, sf_dir):
    sk = S.minhash_sketch(sequences(spark, sf_dir), 9, 200)
    a, b = sk.select(F.col("genome").alias("g1"), F.col("sketch").alias("a")), sk.select(F.col("genome").alias("g2"), F.col("sketch").alias("b"))
    p = a.join(b, F.col("g1") < F.col("g2"))
    low = F.slice(F.array_sort(F.array_union("a", "b")), 1, 200)
    j = F.size(F.array_intersect(low, F.array_intersect("a", "b"))) / F.size(low)
    return p.select("g1", "g2", F.round(j, 9).alias("jaccard"), F.round(S.mash_distance(j, 9), 9).alias("distance"))
