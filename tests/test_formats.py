"""Readers and writers, there and back."""

import gzip

import pytest

from lociweave.plans import records
from lociweave.sources import readers as R
from lociweave.sources import reports
from lociweave.sources import writers as W
from lociweave.streaming import extensions as X


def put(path, text):
    path.write_text(text)
    return str(path)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_genome_list(spark, tmp_path):
    assert rows(R.genome_list(spark, put(tmp_path / "g", "b\na\n\nc\n"))) == [("a", 1), ("b", 0), ("c", 2)]
    with pytest.raises(Exception, match="listed twice"):
        R.genome_list(spark, put(tmp_path / "h", "b\na\nb\n")).collect()


def test_fasta_there_and_back(spark, tmp_path):
    text = ">one first here\nACGT\nAC-GT\r\n>two\n\n>three x\n" + "A" * 130 + "\n"
    f = R.fasta(spark, put(tmp_path / "a.fa", text))
    assert rows(f) == [("one", "one first here", "ACGTAC-GT", 9), ("three", "three x", "A" * 130, 130), ("two", "two", "", 0)]
    W.write_fasta(f, str(tmp_path / "out"))
    assert rows(R.fasta(spark, str(tmp_path / "out"))) == rows(f)
    with gzip.open(tmp_path / "b.fa.gz", "wt") as z:
        z.write(text)
    assert rows(R.fasta(spark, str(tmp_path / "b.fa.gz"))) == rows(f)
    W.write_fasta(f.withColumn("name", f.id), str(tmp_path / "by"), by="name")
    assert (tmp_path / "by" / "name=one").is_dir()


def test_fastq(spark, tmp_path):
    assert rows(R.fastq(spark, put(tmp_path / "q", "@r1 x\nACGT\n+\nIIII\n@r2\nGG\n+\nII\n"))) == [("r1", "ACGT", "IIII"), ("r2", "GG", "II")]


def test_attributes_and_topology(spark, tmp_path):
    a = R.attributes(spark, put(tmp_path / "a", "c1\tf1\t10\t40\tkinase\tg1\nc1\tf2\t90\t50\tpump\tg1\tp\t1|2\th\n"))
    assert [(r.start, r.stop, r.orient, r.role_id) for r in a.orderBy("feat").collect()] == [(10, 40, 1, None), (50, 90, -1, ["1", "2"])]
    assert rows(R.topology(spark, put(tmp_path / "t", "g\tc1\tcircular\ng\tc2\tlinear\n"))) == [("g", "c1", True), ("g", "c2", False)]
    with pytest.raises(Exception, match="unknown topology"):
        R.topology(spark, put(tmp_path / "u", "g\tc1\tround\n")).collect()


def test_hits_of_both_widths(spark, tmp_path):
    wide = ["q2"] + ["x"] * 4 + ["s2", "1", "9", "2", "10", "88.5", "y", "77", *["z"] * 6, "1e-9"]
    h = R.hits(spark, put(tmp_path / "h", "# comment\nq1\ts1\t99.5\t30\t1\t0\t1\t30\t2\t31\t1e-20\t60.5\n" + "\t".join(wide) + "\n"))
    got = {r.qid: r for r in h.collect()}
    assert (got["q1"].pid, got["q1"].send, got["q1"].bitscore) == (99.5, 31, 60.5)
    assert (got["q2"].sid, got["q2"].pid, got["q2"].bitscore, got["q2"].evalue, got["q2"].length) == ("s2", 88.5, 77.0, 1e-9, None)


def test_matchtable_there_and_back(spark, tmp_path):
    m = R.matchtable(spark, put(tmp_path / "m", "1\ta\t----------\n2\t\tb\n3\tc\td\n"), ["g1", "g2"])
    want = [(1, "g1", "a"), (2, "g2", "b"), (3, "g1", "c"), (3, "g2", "d")]
    assert rows(m) == want
    W.matchtable_lines(m, ["g1", "g2"]).write.text(str(tmp_path / "out"))
    assert rows(R.matchtable(spark, str(tmp_path / "out"), ["g1", "g2"])) == want
    with pytest.raises(Exception, match="width"):
        R.matchtable(spark, put(tmp_path / "n", "1\ta\n"), ["g1", "g2"]).collect()


def test_small_formats(spark, tmp_path):
    e = R.adjacency(spark, put(tmp_path / "e", "(1_3,2_5)\t1\t0\n(2_5,1_3)\t1\t0\n(4_5,5_5)\t0\t1\n"), ["x", "y"])
    assert rows(e) == [(1, 3, 2, 5, "x"), (2, 5, 1, 3, "x"), (4, 5, 5, 5, "y")]
    assert rows(R.asymmetric_edges(e).select("c1", "c2")) == [(4, 5)]
    assert rows(R.term_mapping(spark, put(tmp_path / "t", "!head\nPfam:PF1 kin > GO:protein kinase ; GO:0001\n"))) == [("PF1", "kin", "GO:0001", "protein kinase")]
    assert rows(R.hierarchy(spark, put(tmp_path / "y", "L1B1(a, b)\nL2B1(L1B1,c)\n"))) == [(1, 1, "L1B1", "a"), (1, 1, "L1B1", "b"), (2, 1, "L2B1", "L1B1"), (2, 1, "L2B1", "c")]
    line = "tgt PF1 qry - 1e-5 30.5 " + " ".join("0" * 12) + " some words here"
    assert rows(R.hmm_table(spark, put(tmp_path / "m", "# c\n" + line + "\n"))) == [("tgt", "PF1", "qry", 1e-5, 30.5, "some words here")]
    assert rows(R.distance_matrix(spark, put(tmp_path / "d", "n\ta\tb\tc\na\t0\t\t\nb\t1\t0\t\nc\t2\t3\t0\n"))) == [("a", "b", 1.0), ("a", "c", 2.0), ("b", "a", 1.0), ("b", "c", 3.0), ("c", "a", 2.0), ("c", "b", 3.0)]
    assert rows(R.model_database(spark, put(tmp_path / "j", '{"1": {"model_name": "x", "model_type": "t"}, "_v": "3"}')).drop("record")) == [("1", "x", "t")]
    log = "User time (seconds): 1.50\nSystem time (seconds): 0.25\nMaximum resident set size (kbytes): 2048\n"
    assert [tuple(r)[1:] for r in R.resource_logs(spark, put(tmp_path / "l", log)).collect()] == [(1.75, 2.048)]
    g = R.gff_exons(spark, put(tmp_path / "g", "##x\nc\ts\texon\t5\t9\t.\t+\t.\tID=e1;Parent=p\nc\ts\tgene\t1\t9\t.\t+\t.\tID=g\n")).collect()
    assert [(r.start, r.attributes["Parent"]) for r in g] == [(5, "p")]
    known = spark.createDataFrame([("g1",)], "genome string")
    assert rows(R.groupings(spark, put(tmp_path / "k", "g1\tA\tlab\tl\n"), known)) == [("g1", "A", "lab", "l")]
    with pytest.raises(Exception, match="unknown genome"):
        R.groupings(spark, put(tmp_path / "k2", "g9\tA\tlab\tl\n"), known).collect()


def test_genbank_and_xml(spark, tmp_path):
    record = 'LOCUS       AB1  100 bp\nFEATURES             Location/Qualifiers\n     source          1..100\n                     /organism="x"\n     CDS             complement(join(10..20,\n                     30..45))\n                     /locus_tag="L1"\n                     /product="big\n                     kinase"\n                     /translation="MK\n                     LV"\nORIGIN\n        1 acgt\n//\n'
    g = R.genbank(spark, put(tmp_path / "g", record + record.replace("AB1", "AB2"))).where("kind = 'CDS'")
    assert rows(g) == [(n, "CDS", "complement(join(10..20,30..45))", 45, 10, "L1", "big kinase", "MKLV") for n in ("AB1", "AB2")]
    hsp = "<Hsp><Hsp_bit-score>50.5</Hsp_bit-score><Hsp_evalue>1e-9</Hsp_evalue><Hsp_identity>30</Hsp_identity></Hsp>"
    hit = f"<Hit><Hit_def>s1</Hit_def><Hit_hsps>{hsp}</Hit_hsps></Hit><Hit><Hit_def>s2</Hit_def><Hit_hsps>{hsp}</Hit_hsps></Hit>"
    x = f"<R><Iteration><Iteration_query-def>q1</Iteration_query-def><Iteration_hits>{hit}</Iteration_hits></Iteration></R>"
    assert rows(R.search_xml(spark, put(tmp_path / "x", x))) == [("q1", "s1", 1e-9, 50.5, 30), ("q1", "s2", 1e-9, 50.5, 30)]


def test_lines_and_splits(spark, tmp_path):
    p = spark.createDataFrame([("a", "b", 0.5), ("b", "a", 0.5)], "a string, b string, value double")
    assert rows(W.matrix_lines(p, ["a", "b"], 1, 2)) == [("a", "a\t   1.00\t   2.00"), ("b", "b\t   2.00\t   1.00")]
    f = spark.createDataFrame([("c", 1, 9, -1, 7, "g")], "contig string, start int, stop int, orient int, name long, genome string")
    assert W.gff3_lines(f, "s", "CDS").first().value == "c\ts\tCDS\t1\t9\t.\t-\t0\tID=7"
    W.write_synteny(f, str(tmp_path / "syn"))
    assert spark.read.parquet(str(tmp_path / "syn")).where("genome = 'g'").count() == 1
    d = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    W.write_split(d, str(tmp_path / "m"), str(tmp_path / "l"), "x > 3")
    assert (spark.read.parquet(str(tmp_path / "m")).count(), spark.read.parquet(str(tmp_path / "l")).count()) == (1, 2)
    a = spark.createDataFrame([("g1", "GO:1", "F")], "gene string, term string, aspect string")
    assert W.gaf_lines(a, "DB", "20240101", "9").first().value.split("\t")[4] == "GO:1"


def test_streams(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    one = tmp_path / "in"
    events.selectExpr("cast(ts as timestamp) as ts", "event_type", "user_id").coalesce(1).write.parquet(str(one))
    stream = spark.readStream.schema(spark.read.parquet(str(one)).schema).parquet(str(one))
    for name, df, n in (
        ("counts", X.tumbling_counts(stream, "ts", "event_type", "1 day", "1 day"), None),
        ("first", X.first_segments(stream, "ts", ["user_id"], "1000 days"), events.select("user_id").distinct().count()),
    ):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
        got = spark.table(name).count()
        assert got == n if n else got > 0


def test_search_xml_files_follow_the_table(spark, sf_dir, monkeypatch):
    """More hits make more documents, not larger ones."""
    from lociweave.operators.graph import shared_folder
    from lociweave.plans import files as P

    path = str(shared_folder(spark)) + "/search-xml-test"
    monkeypatch.setattr(P, "fresh", lambda spark: path)
    monkeypatch.setattr(P, "FILE_HITS", 100)
    got = P.s09(spark, sf_dir)
    n = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    assert got.count() == n
    sizes = [f.getLen() for d in _listed(spark, path) if d.isDirectory() for f in _listed(spark, d.getPath().toString())]
    assert len(sizes) > 16 and max(sizes) < sum(sizes) / 16


def _listed(spark, path):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)


def test_report_is_dealt_once_and_packed(spark, sf_dir, tmp_path):
    a = records.alignments(spark, sf_dir)
    path = str(tmp_path / "report")
    reports.write_report(a, path, 0.05)
    files = list((tmp_path / "report").glob("part-*"))
    assert files and all(f.name.endswith(".gz") for f in files)
    assert reports.report_alignments(spark, path).count() == a.count()
    # all groups of a report go by query, and so are rows dealt: grouping them shuffles nothing more
    plan = a.groupBy("query", "round", "subject").count().groupBy("query", "round").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
