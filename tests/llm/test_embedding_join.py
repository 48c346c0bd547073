import math

import numpy as np
from pyspark.sql import types as T

from lociweave.llm import embedding_join as E

KIND = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("rep", T.StringType())])


def plain(rows, least=0.98):
    n = {v: 0 for v, _, _ in rows}
    root = {v: v for v in n}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    good = [(v, np.array(e, np.float32).astype(float), y) for v, e, y in rows if e is not None and y is not None and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    for k, (v, e, y) in enumerate(good):
        for w, f, z in good[k + 1 :]:
            if y == z and len(e) == len(f) and e @ f / math.sqrt((e @ e) * (f @ f)) >= least:
                n[v] += 1
                n[w] += 1
                a, b = sorted((find(v), find(w)))
                root[b] = a
    return {v: (n[v], find(v), find(v) == v) for v in n}


def check(spark, rows):
    got = E.link(spark.createDataFrame([(*r, "x") for r in rows], KIND)).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == plain(rows)
    assert len(got) == len(rows)


def test_query_against_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in E.op3_embedding_join(spark, sf_dir).collect()}
    assert got == plain(rows)


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.01], 1), (5, [1.0, 0.0], 2), (6, None, 1), (7, [1.0, 0.0], None), (8, [0.0, 0.0], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [None, 1.0], 1), (12, [1.0, 0.0, 0.0], 1), (13, [], 1), (14, [-1.0, 0.0], 1), (15, [1e-30, 0.0], 1), (16, [3e38, 1e30], 1)]
    check(spark, rows)
    assert E.link(spark.createDataFrame([], KIND)).count() == 0


def test_clusters_over_many_intervals(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 40)
    monkeypatch.setattr(E, "LEAF", 8)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 16))
    rows = []
    for k in range(500):
        v = base[k % 60] + rng.normal(size=16) * rng.choice([0, 0.05, 0.2])
        rows.append((1000 - k, v.astype(np.float32).tolist(), k % 2 if k % 7 else 0))
    check(spark, rows)


def test_pairs_of_blocks_by_recursion(spark, monkeypatch):
    """Many levels and labels: the pairs that survive are those whose bounds come within eps."""
    monkeypatch.setattr(E, "FAN_BITS", 1)
    rng = np.random.default_rng(7)
    rows = []
    for k in range(90):
        lo = np.sort(rng.random(E.LEADING))
        rows.append((k, "a" if k < 60 else "b", 3, lo.tolist(), (lo + 0.1 * rng.random(E.LEADING)).tolist()))
    frame = spark.createDataFrame(rows, "block long, label string, d int, lo array<double>, hi array<double>")
    got = sorted(map(tuple, E.block_pairs(frame, 0.4).collect()))
    want = [(a, b) for a, x, _, la, ha in rows for b, y, _, lb, hb in rows if a <= b and x == y and E.apart(*map(np.array, (la, ha, lb, hb))) <= 0.4]
    assert got == sorted(want) and len(want) < 2000
    assert E.block_pairs(frame.limit(0), 0.4).count() == 0


def test_rows_without_or_with_shared_ids_and_text_labels(spark):
    kind = "vec_id long, embedding array<double>, label string"
    rows = [(None, [1.0, 0.0], "x"), (None, [1.0, 0.001], "x"), (5, [1.0, 0.002], "x"), (None, [0.0, 1.0], "x"), (7, [1.0, 0.0], "y"), (7, [0.0, 1.0], "y"), (8, [0.0, 1.0], "y"), (None, None, "y")]
    got = [tuple(r) for r in E.link(spark.createDataFrame(rows, kind)).collect()]
    want = [(None, 2, 5, False), (None, 2, 5, False), (5, 2, 5, True), (None, 0, None, False), (7, 0, 7, True), (7, 1, 7, True), (8, 1, 7, False), (None, 0, None, False)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = sorted(con.execute(E.OP3_SQL).fetchall())
    got = E.op3_embedding_join(spark, sf_dir).select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == want
