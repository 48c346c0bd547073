import random

import numpy as np
from pyspark.sql import types as T

from lociweave.llm import decontamination as D

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("item_id", T.StringType()), T.StructField("lang", T.StringType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("doc_id", T.StringType())])


def fold(t):
    return " ".join((t or "").lower().split())


def least_edits(item, text):
    """Edits of the best occurrence of item in text."""
    prev = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        cur = [i]
        for j, d in enumerate(text, 1):
            cur.append(min(prev[j - 1] + (c != d), prev[j] + 1, cur[-1] + 1))
        prev = cur
    return min(prev)


def test_query_against_search(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id): r for r in D.op1_decontamination(spark, sf_dir).collect()}
    texts = {d.doc_id: fold(d.text) for d in docs}
    whole = {(d, i.item_id) for d, t in texts.items() for i in items if fold(i.text) in t}
    assert whole and whole <= set(got)
    for (d, i), r in got.items():
        item = fold(next(x.text for x in items if x.item_id == i))
        assert r.edits == least_edits(item, texts[d]) <= D.budget(len(item))[0]
        text = next(x.text for x in docs if x.doc_id == d)
        assert r.edits or fold(text[r.start : r.end]) == item


def test_edited_copies_against_full_alignment():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    items = [(k, " ".join(word() for _ in range(rng.choice([4, 10, 30])))) for k in range(12)]
    texts = []
    for _, t in items:
        for share in (0, 0.03, 0.08, 0.1, 0.12, 0.2):
            c = list(t)
            for _ in range(int(share * len(t))):
                k, do = rng.randrange(len(c)), rng.random()
                c[k : k + 1] = [] if do < 0.3 else [rng.choice("xyz")] if do < 0.6 else [c[k], rng.choice("xyz")]
            texts.append(" ".join(word() for _ in range(rng.randint(0, 30))) + " " + "".join(c) + " " + " ".join(word() for _ in range(rng.randint(0, 30))))
    got = {(t, k): e for t, k, _, _, e in D.leaks_in(D.Items(items, D.EDITS), texts)}
    want = {}
    for t, text in enumerate(texts):
        for k, (_, item) in enumerate(items):
            e = least_edits(fold(item), fold(text))
            if e <= D.budget(len(fold(item)))[0]:
                want[t, k] = e
    assert got == want


def test_cases(spark, monkeypatch):
    passage = "A Passage of the benchmark, long enough to be told from others by its letters."
    docs = [(1, None, None, None), (2, "", None, None), (3, "before " + passage.upper().replace(" ", "\n  ") + " after", "x", "en"), (3, passage, None, None), (None, passage, None, None), (4, "b" * 300_000 + passage + "c" * 300_000, None, None), (5, "clean text of no concern", None, None)]
    items = [(1, passage, None), (2, None, None), (3, "", None), (4, "abc", None), (5, passage, "y")]
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    got = sorted(((r.doc_id or 0, r.item_id, r.edits) for r in D.find_leaks(d, i).collect()))
    want = sorted((x, y, 0) for x in (3, 3, 0, 4) for y in (1, 5))
    assert got == want
    monkeypatch.setattr(D, "BLOCK_CHARS", 10)
    assert sorted(((r.doc_id or 0, r.item_id, r.edits) for r in D.find_leaks(d, i).collect())) == want
    kept = D.keep_clean(d, i)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {1, 2, 5}
    assert D.find_leaks(d.limit(0), i).count() == 0 and D.find_leaks(d, i.limit(0)).count() == 0 and D.keep_clean(d, i.limit(0)).count() == len(docs)


def test_short_items_against_full_alignment():
    """Items of 1 to 45 characters have the same budget as long ones, down to verbatim search."""
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abc de") for _ in range(n))
    items = [(n, ("x" + text(n) + "y")[:n].replace(" ", "z")) for n in range(1, 46)]
    texts = []
    for n, t in items:
        for _ in range(3):
            c = list(t)
            for _ in range(rng.randint(0, n // 10 + 1)):
                c[rng.randrange(len(c))] = rng.choice("qw")
            texts.append(text(30) + "".join(c) + text(20))
    got = {(t, items[k][0]): e for t, k, _, _, e in D.leaks_in(D.Items(items, D.EDITS), texts)}
    want = {}
    for t, x in enumerate(texts):
        for n, item in items:
            e = least_edits(fold(item), fold(x))
            if e <= int(D.EDITS * n):
                want[t, n] = e
    assert got == want and len({n for _, n in want}) > 30


def test_grams_of_any_length():
    codes = np.frombuffer("abcabcabc".encode("utf-32-le"), "<u4")
    for q in range(1, 10):
        g = D.grams(codes, q)
        assert len(g) == 10 - q and len(set(g.tolist())) == min(3, 10 - q)
    assert len(D.grams(codes, 10)) == 0


def test_many_blocks_and_popular_texts(spark, monkeypatch):
    """Results do not depend on the number of blocks; item ids may be text."""
    rng = random.Random(7)
    items = [(f"i{k}", " ".join(str(rng.randint(0, 10**6)) for _ in range(12))) for k in range(40)]
    docs = [(k, "some words " + (items[k % 40][1] if k % 3 == 0 else str(k)), {"a": k}) for k in range(120)] + [(k, "some words " + items[0][1], None) for k in range(200, 900)]
    d = spark.createDataFrame(docs, "doc_id long, text string, more map<string,long>")
    i = spark.createDataFrame(items, "item_id string, text string")
    one = sorted(map(tuple, D.find_leaks(d, i).collect()))
    kept = {r.doc_id for r in D.keep_clean(d, i).collect()}
    monkeypatch.setattr(D, "BLOCK_CHARS", 700)
    assert sorted(map(tuple, D.find_leaks(d, i).collect())) == one and len(one) == 40 + 700
    assert {r.doc_id for r in D.keep_clean(d, i).collect()} == kept == {k for k in range(120) if k % 3}
