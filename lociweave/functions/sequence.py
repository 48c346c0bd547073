"""Column functions over nucleotide and protein sequences; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Nucleotide codes and their complements.
BASES, COMPLEMENTS = "ACGTNacgtn", "TGCANtgcan"
IUPAC, IUPAC_COMPLEMENTS = "ACGTURYSWKMBDHVNacgturyswkmbdhvn", "TGCAAYRSWMKVHDBNtgcaayrswmkvhdbn"
#: Translation table 11, amino acids in the order of codons over T, C, A, G.
TABLE_11 = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
STOPS = ("TAA", "TAG", "TGA")


def reverse_complement(seq: Column, upper: bool = True) -> Column:
    """Of A, C, G, T and N; in upper case unless told otherwise."""
    return F.reverse(F.translate(F.upper(seq) if upper else seq, BASES, COMPLEMENTS))


def reverse_complement_iupac(seq: Column) -> Column:
    """Of all ambiguity codes, case kept."""
    return F.reverse(F.translate(seq, IUPAC, IUPAC_COMPLEMENTS))


def subsequence(seq: Column, start: Column, stop: Column) -> Column:
    """From start to stop, 1-based and inclusive, as far as the sequence goes; on the reverse strand where stop is before start."""
    low, high = F.least(start, stop), F.greatest(start, stop)
    part = F.substring(seq, low, high - low + 1)
    return F.when(start <= stop, part).otherwise(reverse_complement(part))


def circular_subsequence(seq: Column, start: Column, length: Column) -> Column:
    """From start on, going on at the beginning as often as the end is passed; of an empty sequence an empty one."""
    n = F.length(seq)
    at = F.pmod(start - 1, n) + 1
    around = F.substring(F.repeat(seq, F.ceil((at - 1 + length) / n).cast("int")), at, length)
    return F.when(n > 0, around).otherwise(seq)


def ungap(seq: Column) -> Column:
    return F.regexp_replace(seq, "[-.]", "")


def clean(seq: Column, keep: str = "a-zA-Z") -> Column:
    return F.regexp_replace(seq, f"[^{keep}]", "")


def mask_ambiguous(seq: Column) -> Column:
    """Any letter but A, C, G, T as N, upper case."""
    return F.upper(F.regexp_replace(seq, "[^ACGTacgt]", "N"))


def codons(seq: Column, frame: int = 0) -> Column:
    """Whole codons of a frame in order; the pattern walks the text once."""
    return F.regexp_extract_all(F.substring(seq, frame + 1, 2147483647), F.lit("(...)"), F.lit(1))


def translate(seq: Column) -> Column:
    """Protein of the first frame by table 11; X where a codon has another letter."""

    def amino(codon: Column) -> Column:
        digit = lambda k: F.instr(F.lit("TCAG"), F.substring(codon, F.lit(k), F.lit(1))) - 1
        at = digit(1) * 16 + digit(2) * 4 + digit(3)
        return F.when(codon.rlike("^[ACGT]{3}$"), F.substring(F.lit(TABLE_11), at + 1, F.lit(1))).otherwise("X")

    return F.array_join(F.transform(codons(F.upper(seq)), amino), "")


def open_frames(seq: Column) -> Column:
    """Six booleans: whether a frame, three forward and three reverse, has no stop codon."""
    both = F.array(F.upper(seq), reverse_complement(seq))
    return F.flatten(F.transform(both, lambda x: F.array(*(~F.arrays_overlap(codons(x, f), F.array(*map(F.lit, STOPS))) for f in range(3)))))


def kmers(seq: Column, k: int) -> Column:
    """All k-mers of A, C, G, T in order; those over other letters are left out."""
    return F.regexp_extract_all(seq, F.lit(f"(?=([ACGT]{{{k}}}))"), F.lit(1))


def canonical(kmer: Column) -> Column:
    """The smaller of a k-mer and its reverse complement."""
    return F.least(kmer, reverse_complement(kmer))


def wrap(seq: Column, width: int = 60) -> Column:
    """Lines of the width, each with a line feed but the last."""
    return F.regexp_replace(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), "\n$", "")


def _matches(a: Column, b: Column, ignore: str) -> Column:
    both = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when((x == "") | (y == "") | x.isNull() | y.isNull() | F.lit(ignore).contains(x) | F.lit(ignore).contains(y), F.lit(None)).otherwise((x == y).cast("int")))
    return F.filter(both, lambda x: x.isNotNull())


def identity(a: Column, b: Column, ignore: str = "-") -> Column:
    """Share of equal letters among the columns where neither row has an ignored letter; null without such columns."""
    m = _matches(a, b, ignore)
    return F.when(F.size(m) > 0, F.aggregate(m, F.lit(0), lambda s, x: s + x) / F.size(m))


def distance(a: Column, b: Column) -> Column:
    """Share of differing letters, gaps and N ignored."""
    return 1 - identity(F.upper(a), F.upper(b), "-N")


def header_field(header: Column, n: int, separator: str = "|") -> Column:
    return F.split_part(header, F.lit(separator), F.lit(n))


def snp(spec: Column) -> Column:
    """Struct original, position, change of a spec such as A123B; null if it is none."""
    part = lambda k: F.regexp_extract(spec, "^([A-Z*])([0-9]+)([A-Z*])$", k)
    return F.when(part(1) != "", F.struct(part(1).alias("original"), part(2).cast("int").alias("position"), part(3).alias("change")))


def has_snp(protein: Column, spec: Column) -> Column:
    s = snp(spec)
    return F.substring(protein, s["position"], F.lit(1)) == s["change"]


def dash_offset(gapped: Column, position: Column) -> Column:
    """Gaps among the first `position` columns."""
    head = F.substring(gapped, F.lit(1), position)
    return F.length(head) - F.length(F.replace(head, F.lit("-"), F.lit("")))


def soft_mask(seq: Column, starts: Column, length: int) -> Column:
    """Lower case but for the given stretches, as far as the sequence goes."""
    return F.aggregate(starts, F.lower(seq), lambda s, at: F.overlay(s, F.upper(F.substring(seq, at, F.lit(length))), at))


def locus_prefix(locus: Column) -> Column:
    return F.regexp_extract(locus, "^(.*?)_?[0-9]+$", 1)


#: Least share of the length, its score; least identity, its score.
LENGTH_BANDS = ((0.98, 2.0), (0.95, 1.0), (0.9, 0.5), (0.8, 0.25), (0.7, 0.1), (0.5, 0.05))
IDENTITY_BANDS = ((0.98, 1.0), (0.95, 0.75), (0.9, 0.5), (0.8, 0.25), (0.7, 0.1), (0.5, 0.05))


def banded(value: Column, bands: tuple[tuple[float, float], ...]) -> Column:
    """The score of the first band whose least value is reached, else 0."""
    return F.coalesce(*(F.when(value >= least, F.lit(score)) for least, score in bands), F.lit(0.0))


def homology_score(pid: Column, share: Column, prevalence: Column, hits: Column, single_copy: Column) -> Column:
    """Score of a hit: bands of length share and identity (percent, compared as a fraction), prevalence of the cluster (0 to 1), one over its hits, 1 if single-copy core."""
    return single_copy.cast("double") + prevalence + 1 / hits + banded(pid / 100, IDENTITY_BANDS) + banded(share, LENGTH_BANDS)


def buffered_length(n: Column) -> Column:
    """How much sequence to take for an alignment of n characters. The numbers are fixed values."""
    longer = F.when(n < 50, 2 * n + 1).when(n < 100, 1.5 * n + 26).when(n < 1000, 1.2 * n + 56).otherwise(1.1 * n + 156)
    return F.floor(longer).cast("long")


def introduced_stops(seq: Column, open_before: Column) -> Column:
    """(frame, offset) of the first stop codon in each frame that open_before, six booleans, has as open; the codon that ends the sequence does not count.

    Frames are 1 to 3 forward and -1 to -3 on the reverse complement.
    """
    both = ((F.upper(seq), 1), (reverse_complement_iupac(F.upper(seq)), -1))
    found = []
    for side, (text, sign) in enumerate(both):
        for f in range(3):
            places = (F.nullif(F.array_position(codons(text, f), stop), F.lit(0)) for stop in STOPS)
            hit = F.array_min(F.array(*places))
            at = (hit - 1) * 3 + f
            good = F.get(open_before, F.lit(3 * side + f)) & (at <= F.length(seq) - 4)
            found.append(F.when(good, F.struct(F.lit(sign * (f + 1)).alias("frame"), at.cast("int").alias("offset"))))
    return F.array_compact(F.array(*found))


def coordinates(text: Column) -> Column:
    """Struct end5, end3 of a location such as complement(join(10..20,30..40)): its whole extent, turned on the reverse strand."""
    n = F.transform(F.regexp_extract_all(text, F.lit("([0-9]+)"), F.lit(1)), lambda x: x.cast("long"))
    low, high = F.array_min(n), F.array_max(n)
    turned = text.contains("complement")
    return F.struct(F.when(turned, high).otherwise(low).alias("end5"), F.when(turned, low).otherwise(high).alias("end3"))


def intron_phases(lengths: Column) -> Column:
    """Phase of the intron after each exon but the last, from exon lengths in order."""
    sums = F.transform(F.sequence(F.lit(1), F.size(lengths) - 1), lambda i: F.aggregate(F.slice(lengths, 1, i), F.lit(0).cast("long"), lambda s, x: s + x))
    return F.when(F.size(lengths) > 1, F.transform(sums, lambda s: (s % 3).cast("int"))).otherwise(F.array().cast("array<int>"))


def kmer_counts(sequences: DataFrame, k: int) -> DataFrame:
    """genome, kmer (canonical), n. Occurrences are counted first, so that only distinct k-mers are turned."""
    raw = sequences.select("genome", F.explode(kmers(F.col("seq"), k)).alias("kmer")).groupBy("genome", "kmer").agg(F.count(F.lit(1)).alias("n"))
    return raw.groupBy("genome", canonical(F.col("kmer")).alias("kmer")).agg(F.sum("n").alias("n"))


def anchor_kmers(sequences: DataFrame, k: int, genomes: int) -> DataFrame:
    """kmer, n_genomes: canonical k-mers that occur once at most in each genome, and in at least so many."""
    by = kmer_counts(sequences, k).groupBy("kmer").agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("n_genomes"))
    return by.where((F.col("most") == 1) & (F.col("n_genomes") >= genomes)).select("kmer", "n_genomes")


def minhash_sketch(sequences: DataFrame, k: int, size: int) -> DataFrame:
    """genome, sketch: the smallest hashes of its canonical k-mers; each genome's k-mers are reduced before they are gathered."""
    from pyspark.sql import Window

    h = kmer_counts(sequences, k).select("genome", F.xxhash64("kmer").alias("h"))
    low = h.withColumn("r", F.row_number().over(Window.partitionBy("genome", F.pmod("h", F.lit(16))).orderBy("h"))).where(F.col("r") <= size)
    low = low.withColumn("r", F.row_number().over(Window.partitionBy("genome").orderBy("h"))).where(F.col("r") <= size)
    return low.groupBy("genome").agg(F.sort_array(F.collect_list("h")).alias("sketch"))


def mash_distance(jaccard: Column, k: int) -> Column:
    """-ln(2j / (1 + j)) / k; 1 where nothing is shared."""
    return F.when(jaccard > 0, -F.log(2 * jaccard / (1 + jaccard)) / k).otherwise(1.0)


def alignment_columns(rows: DataFrame) -> DataFrame:
    """aln, pos, base, n: letters of each column of aligned rows (aln, id, seq)."""
    e = rows.select("aln", F.posexplode(F.split("seq", ""))).where("col <> ''")
    return e.groupBy("aln", (F.col("pos") + 1).alias("pos"), F.col("col").alias("base")).agg(F.count(F.lit(1)).alias("n"))


def conserved_positions(rows: DataFrame) -> DataFrame:
    """aln, pos, base of columns with one letter only, no gap."""
    g = alignment_columns(rows).groupBy("aln", "pos").agg(F.count(F.lit(1)).alias("kinds"), F.min("base").alias("base"))
    return g.where("kinds = 1 and base <> '-'").select("aln", "pos", "base")


def unique_alleles(rows: DataFrame) -> DataFrame:
    """aln, id, n: letters that no other row has in their column."""
    e = rows.select("aln", "id", F.posexplode(F.split("seq", ""))).where("col <> ''")
    one = e.groupBy("aln", "pos", "col").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")).where("n = 1")
    return one.groupBy("aln", "id").agg(F.count(F.lit(1)).alias("n"))


def sanitized_header(header: Column) -> Column:
    """Runs of characters that tools trip over as one underscore."""
    return F.regexp_replace(header, "[^A-Za-z0-9_.|-]+", "_")


def valid_header(header: Column) -> Column:
    """Whether a FASTA header line has an id of visible characters right after its sign."""
    return F.coalesce(header.rlike("^>[!-~]+( .*)?$"), F.lit(False))


def valid_sequence(seq: Column, protein: bool = False) -> Column:
    """Whether all letters are nucleotide codes, or amino acids with stops."""
    return F.coalesce(seq.rlike("^[A-IK-NP-Z*a-ik-np-z-]+$" if protein else "^[ACGTURYSWKMBDHVNacgturyswkmbdhvn-]+$"), F.lit(False))


def nucleotide_snp(seq: Column, spec: Column) -> Column:
    """mutant, wild type or other: which letter of a spec such as A123G the sequence has at its place; null where it has none."""
    s = snp(spec)
    at = F.substring(F.upper(seq), s["position"], F.lit(1))
    return F.when(at == s["change"], "mutant").when(at == s["original"], "wild type").when(at != "", "other")


def date_strings(at: Column) -> Column:
    """Struct iso, sql, log: the three forms of a time stamp that reports use."""
    form = lambda f, n: F.date_format(at, f).alias(n)
    return F.struct(form("yyyy-MM-dd'T'HH:mm:ss", "iso"), form("yyyy-MM-dd HH:mm:ss", "sql"), form("yyyyMMdd.HHmmss", "log"))
