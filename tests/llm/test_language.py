import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from lociweave.llm import language as L

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("score", T.StringType()), T.StructField("gram", T.LongType())])
M = (1 << 64) - 1


def gram_hash(gram):
    h = 0
    for c in gram:
        h = (h * 0x9E3779B97F4A7C15 + ord(c)) & M
    x = (h + len(gram)) & M
    x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & M
    return (x ^ (x >> 29)) & ((1 << 48) - 1)


def grams(text):
    """All n-grams of a text, word by word."""
    out, cache = Counter(), gram_hash.__dict__.setdefault("cache", {})
    low = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    blank = " "
    for word in low.split():
        padded = blank + word + blank
        for n in range(1, 6):
            for k in range(len(padded) - n + 1):
                g = padded[k : k + n]
                if g != blank:
                    out[g] += 1
    # a blank between two words belongs to both of them: n-grams never hold one inside, so nothing is shared
    for g in out:
        if g not in cache:
            cache[g] = gram_hash(g)
    return out


def profile(counts):
    cache = gram_hash.__dict__.setdefault("cache", {})
    best = sorted(counts, key=lambda g: (-counts[g], cache[g]))[: L.PROFILE]
    return {g: k for k, g in enumerate(best)}


def plain(docs):
    total = defaultdict(Counter)
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 4 == 2
    own = [grams(t) for _, t, _ in docs]
    for (d, t, lang), g in zip(docs, own, strict=True):
        if lang is not None and t is not None and not held(d):
            total[lang].update(g)
    known = {lang: profile(c) for lang, c in total.items() if c}
    out = []
    for (d, _, _), g in zip(docs, own, strict=True):
        p = profile(g)
        if not p or not known:
            out.append((d, held(d), "und", 0.0))
            continue
        cost = {lang: sum(abs(r - q[x]) if x in q else L.PROFILE for x, r in p.items()) for lang, q in known.items()}
        lang = min(cost, key=lambda x: (cost[x], x))
        out.append((d, held(d), lang, 1 - cost[lang] / (len(p) * L.PROFILE)))
    return out


def same(rows, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[3])
    got = sorted(((r.doc_id, r.held_out, r.lang_pred, r.score) for r in rows), key=key)
    want = sorted(want, key=key)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-12)


def op(df):
    df = df.select("doc_id", "text", "lang")
    out = L.predict(df, L.learn(df.where(~L.held_out(L.F.col("doc_id")))))
    return out.withColumn("held_out", L.held_out(L.F.col("doc_id")))


def test_query_and_held_out_accuracy(spark, sf_dir):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = L.op12_language_id(spark, sf_dir).collect()
    same(rows, plain(docs))
    lang = {d: x for d, _, x in docs}
    held = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert len(held) > 20 and sum(held) >= 0.95 * len(held)


def test_cases(spark, monkeypatch):
    rng = random.Random(2)
    docs = []
    for k in range(60):
        letters = ["abcdeé", "cdefgñ", "xyzab中"][k % 3]
        docs.append((k, " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 60))), ["aa", "bb", "cc"][k % 3]))
    docs += [(100, None, "aa"), (101, "", "bb"), (102, "12 -- !?", "aa"), (103, "abc", None), (None, "xİY ΣΑΣ straße", "cc"), (None, "x", None), (7, docs[7][1], "aa"), (7, docs[7][1], "aa"), (104, "Abc" * 40_000, "aa"), (105, "q w " * 20_000, "bb")]
    df = spark.createDataFrame([(*d, "own", 1) for d in docs], DOCS)
    same(op(df).collect(), plain(docs))
    assert op(df.limit(0)).count() == 0
    unlabelled = [(d, t, None) for d, t, _ in docs]
    assert {r.lang_pred for r in op(spark.createDataFrame([(*d, None, None) for d in unlabelled], DOCS)).collect()} == {"und"}
    monkeypatch.setattr(L, "PART", 1000)
    t = docs[-2][1] + " " + docs[0][1]
    keys, counts = L.tallied([t, docs[1][1]])
    want = {(0 << 48) | gram_hash(g): n for g, n in grams(t).items()} | {(1 << 48) | gram_hash(g): n for g, n in grams(docs[1][1]).items()}
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == want
