import public_tokenizers
from pyspark.sql import types as T
from tokenizers import Tokenizer

from lociweave.llm import token_counts as C
from tests.llm.test_packing import TRICKY

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_bytes", T.StringType())])
MORE = ["  two  blanks ", "a \n b\n\nc   d  e   f", "x   y \n", " 'll 're", "don't 's", "\n", " ", "a\t b\t\tc", "a\tb\tc   d", "a\u00a0b\u00a0c   d", " a\tb", "a\tb ", "1 2  3  4"]


def whole(text):
    t = whole.__dict__.setdefault("t", Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    return len(t.encode(text or "", add_special_tokens=False).ids)


def check(rows, docs):
    got = sorted(((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in rows))
    assert got == sorted((d or -1, len((t or "").encode()), n, n > 1024) for d, t in docs for n in [whole(t)])


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(C.op9_token_counts(spark, sf_dir).collect(), docs)


def test_tricky_texts_and_cases(spark):
    docs = list(enumerate([*TRICKY, *MORE], 1)) + [(None, "one two"), (3, "again"), (3, "again")]
    df = spark.createDataFrame([(*d, "x") for d in docs], DOCS)
    check(C.count_tokens(df).collect(), docs)
    assert C.count_tokens(df.limit(0)).count() == 0
