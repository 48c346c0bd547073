import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociweave.llm import infill as I

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("output", T.StringType()), T.StructField("_h", T.StringType())])
TEXTS = ["", None, "\n", "\n\n\n", "one", "one\n", "one\ntwo", "a\r\nb\rc\n", "über\n中文\n\U0001f600 x\n\ny", "has <P> in\nit", "<M>", "x <S", "<\n<\nP>\n<", "l\n" * 70_000, "w" * 300_000 + "\n" + "ä" * 1000, " \n \n", "tab\t\n\x0b\n\x85 x\n"]


def plain(doc_id, text, seed=7, rate=100, spm=50, marks=("<P>", "<S>", "<M>")):
    """The contract, word by word."""
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    lines = re.findall("[^\n]*\n|[^\n]+", text)
    n = len(lines)
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (lines[:one], lines[one:two], lines[two:]))
    if not text or any(m in text for m in marks) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    p, s, m = marks
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(pre), len(mid), s + suf + p + pre + m + mid
    return doc_id, n, "psm", len(pre), len(mid), p + pre + s + suf + m + mid


def rows(df):
    return sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[5]))


def test_cases(spark):
    docs = [(k, t) for k, t in enumerate(TEXTS * 3)] + [(None, "a\nb\nc\n"), (None, None), (4, "twice\nx"), (4, "twice\nx")]
    df = spark.createDataFrame([(*d, "own", "own") for d in docs], DOCS)
    for options in ({}, {"seed": 11, "rate": 40, "spm": 0, "marks": ("<a.b>", "$1", "[m")}):
        given_ = {k: v for k, v in options.items() if k != "marks"} | ({"sentinels": options["marks"]} if options else {})
        out = I.fill_in_middle(df, **given_)
        want = sorted((plain(*d, **options) for d in docs), key=lambda r: (r[0] is None, r[0] or 0, r[5]))
        assert rows(out) == want
        marks = given_.get("sentinels", ("<P>", "<S>", "<M>"))
        back = out.select("doc_id", I.restored(F.col("form"), F.col("output"), marks).alias("t")).collect()
        key = lambda x: (x[0] is None, x[0] or 0, x[1])
        assert sorted(map(tuple, back), key=key) == sorted(((d, t or "") for d, t in docs), key=key)
    assert I.fill_in_middle(df.limit(0)).count() == 0


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {d: (*plain(d, t)[1:5], sha(plain(d, t)[5]), sha(t or "")) for d, t in docs}
    assert {r.doc_id: tuple(r)[1:] for r in I.op11_fill_in_middle(spark, sf_dir).collect()} == want


def test_sql(spark, sf_dir):
    import duckdb

    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    assert sorted(db.sql(I.OP11_SQL).fetchall()) == sorted(map(tuple, I.op11_fill_in_middle(spark, sf_dir).collect()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.booleans(), max_size=3000))
def test_rank_select(bits):
    marks = np.array(bits, bool)
    r = I.RankSelect(marks)
    places = np.arange(len(bits) + 1)
    assert r.rank(places).tolist() == [int(marks[:k].sum()) for k in places]
    at = np.flatnonzero(marks)
    assert r.select(np.arange(len(at))).tolist() == at.tolist()


def test_runs():
    assert list(I.byte_runs(np.array([0, 3, 3, 20, 21, 22]), 5)) == [(0, 2), (2, 3), (3, 5)]
    assert list(I.byte_runs(np.array([0]))) == []
