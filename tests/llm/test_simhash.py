import itertools
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociweave.llm import simhash as S
from lociweave.llm.common import join_counted, join_salted

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("fp", T.StringType())])


def plain_fingerprint(text, words=3):
    w = ["".join(c.lower() if c.isascii() else c for c in x) for x in (text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if x]
    if not w:
        return 0
    parts = [" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    """fps: list of (doc_id, fp)."""
    root = {d: d for d, _ in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, x), (b, y) in itertools.combinations(fps, 2):
        if (x ^ y).bit_count() <= 2:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {d: find(d) for d, _ in fps}


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in S.op6_simhash(spark, sf_dir).collect()}
    fps = [(r.doc_id, plain_fingerprint(r.text)) for r in docs]
    want = plain_components(fps)
    assert len(got) == len(docs)
    for d, fp in fps:
        assert got[d].fingerprint == f"{fp:016x}"
        assert got[d].component_id == want[d]


def test_cases(spark):
    rows = [(1, None, None, "x"), (2, "", "en", None), (3, "One two", None, None), (4, "one TWO", None, None), (None, "one two", None, None), (5, "a b c d " * 40_000, None, None), (5, "a b c d " * 40_000, None, None)]
    got = S.simhash_components(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add(r.component_id)
    assert by == {1: {1}, 2: {1}, 3: {3}, 4: {3}, None: {3}, 5: {5}}
    assert S.simhash_components(spark.createDataFrame([], DOCS)).count() == 0


def test_near_pairs_and_hot_groups(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    fps = np.concatenate([base, base ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)), base ^ np.uint64(7)])
    for radius in (1, 2, 3, 5):
        i, j = S.near_pairs(fps[:, None], None, radius)
        want = {(a, b) for a, b in itertools.combinations(range(len(fps)), 2) if (int(fps[a]) ^ int(fps[b])).bit_count() <= radius}
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == want
        i, j = S.near_pairs(fps[:250, None], fps[250:, None], radius)
        assert {(a, b + 250) for a, b in zip(i.tolist(), j.tolist(), strict=True)} == {(a, b) for a, b in want if a < 250 <= b}
    monkeypatch.setattr(S, "HOT", 64)
    monkeypatch.setattr(S, "BLOCK", 32)
    monkeypatch.setattr(S, "SHARE", 1)
    rows = spark.createDataFrame([(k % 2, n, int(f).to_bytes(8, "little")) for n, f in enumerate(fps) for k in (0, 1)], "key long, node long, fp binary")
    edges = S.block_links(rows, 2, len(fps)).collect()
    i, j = S.near_pairs(fps[:, None], None, 2)
    want = S.lowest(len(fps), i, j)
    e = np.array([(r.a, r.b) for r in edges])
    assert (S.lowest(len(fps), e[:, 0], e[:, 1]) == want).all()


def test_keep_first_drops_near_copies(spark):
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(5000)]
    base = [" ".join(rng.choice(words, 300)) for _ in range(20)]
    rows = [(k, t, "en", "s") for k, t in enumerate(base)]
    for k, t in enumerate(base[:10]):
        w = t.split()
        w[5], w[150] = "x", "y"
        rows.append((100 + k, " ".join(w), "en", "s"))
    rows += [(200, base[3].upper(), None, None), (None, base[4], None, None)]
    kept = S.keep_first(spark.createDataFrame(rows, DOCS))
    assert kept.columns == [f.name for f in DOCS]
    assert {r.doc_id for r in kept.collect()} == set(range(20)) | {None}


def test_popular_keys_join_like_others(spark):
    keys = [0] * 700 + [1] * 9 + list(range(2, 1300))
    rows = spark.createDataFrame([(k, f"row {r}") for r, k in enumerate(keys)], "k long, row string")
    keyed = spark.createDataFrame([(k, n, k * 10) for k, n in Counter(keys).items() if k != 5], "k long, n long, v long")
    got = join_counted(rows, keyed, ["k"], len(keys), "n")
    assert sorted(map(tuple, got.select("k", "row", "v").collect())) == sorted((k, f"row {r}", k * 10) for r, k in enumerate(keys) if k != 5)
    assert "n" not in got.columns


def plain_like(a, b, n=5):
    sets = []
    for t in (a, b):
        w = t.lower().split()
        sets.append({" ".join(w[k : k + n]) for k in range(max(1, len(w) - n + 1))})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_nearest_forests_are_the_cheapest():
    rng = np.random.default_rng(4)
    n = 40
    i, j = np.triu_indices(n, 1)
    some = rng.random(len(i)) < 0.3
    i, j = i[some], j[some]
    d = rng.integers(0, 20, len(i))

    def plain(order):
        label, out = np.arange(n), []
        for k in order:
            if label[i[k]] != label[j[k]]:
                out.append(k)
                label[label == label[j[k]]] = label[i[k]]
        return out

    first = plain(np.argsort(d, kind="stable"))
    second = plain([k for k in np.argsort(d, kind="stable") if k not in set(first)])
    got = S.nearest_forests(n, i, j, d)
    assert sorted(got.tolist()) == sorted(first + second)
    assert S.bits_apart(np.array([[3], [1], [255]], np.uint64), np.array([0, 0]), np.array([1, 2])).tolist() == [1, 6]


def test_keep_first_goes_by_exact_similarity(spark):
    """Texts of every size around 0.8, short ones too: exactly those go that reach it with an earlier one."""
    rng = np.random.default_rng(5)
    rows, k = [], 0
    for n in (5, 6, 7, 8, 9, 12, 20, 60, 300):
        for edits in range(1, 12):
            w = [f"v{x}" for x in rng.integers(0, 10**6, n)]
            other = list(w)
            for at in rng.choice(n, min(n, edits * n // 60 or (edits % 2)), replace=False):
                other[at] = f"u{rng.integers(0, 10**6)}"
            rows += [(k, " ".join(w), "", ""), (k + 1, " ".join(other + ["more"] * (edits % 3 == 1)), "", "")]
            k += 2
    kept = {r.doc_id for r in S.keep_first(spark.createDataFrame(rows, DOCS)).collect()}
    want = {d for d, t, *_ in rows if d % 2 == 0 or plain_like(rows[d - 1][1], t) < 0.8 - 1e-9}
    assert kept == want and len(rows) - len(want) >= 15
    assert S.keep_first(spark.createDataFrame([], DOCS)).count() == 0
    same = [(9, None, None, None), (8, "", None, None), (7, "a b", "x", None), (None, "a b", None, None)]
    assert sorted((r.doc_id for r in S.keep_first(spark.createDataFrame(same, DOCS)).collect()), key=str) == [7, 8, None]


def test_popular_keys_meet_copies_of_wide_rows(spark):
    keys = [0] * 700 + [1] * 9 + list(range(2, 1300))
    rows = spark.createDataFrame([(k, r) for r, k in enumerate(keys)], "k long, row long")
    keyed = spark.createDataFrame([(k, [k] * 3) for k in set(keys) if k != 5], "k long, v array<long>")
    got = join_salted(rows, keyed, "k")
    assert got.columns == ["k", "row", "v"]
    assert sorted((r.k, r.row, r.v[0]) for r in got.collect()) == sorted((k, r, k) for r, k in enumerate(keys) if k != 5)


def test_rows_without_doc_id_pass_links_on(spark):
    far = 0xF0F0F0F0 << 20
    rows = [(9, 7), (None, 3), (1, 0), (1, 0), (None, far), (None, far + 1), (4, 0xFFFFFF << 36)]
    df = spark.createDataFrame([(d, b.to_bytes(8, "little"), b) for d, b in rows], "doc_id long, fp binary, bits long")
    got = S.near_components(df, 2, S.part_keys(2)).collect()
    assert sorted((r.bits, r.component_id) for r in got) == sorted([(7, 1), (3, 1), (0, 1), (0, 1), (far, None), (far + 1, None), (0xFFFFFF << 36, 4)], key=lambda r: r[0])


@pytest.mark.parametrize("rest", [1, 20_000])
def test_near_pairs_beyond_the_forests_link(spark, monkeypatch, rest):
    """Of eight fingerprints in a line only the outermost pair, the last that a forest would take, and one beside it are similar."""
    monkeypatch.setattr(S, "REST", rest)
    rows = [(k, np.packbits(np.arange(1024) < 5 * k, bitorder="little").tobytes(), [7, k]) for k in range(1, 9)]
    prints = spark.createDataFrame(rows, "doc_id long, fp binary, bands array<long>")
    similar = lambda pairs: pairs.where("a = 1 and b = 8 or a = 2 and b = 7")
    got = {r.doc_id: r.component_id for r in S.near_components(prints, 100, F.col("bands"), similar).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 2, 8: 1}


def test_wide_columns_come_after_keys_of_one_row_went(spark):
    """Only rows of shared keys meet fingerprints; rows that share a doc_id keep theirs apart."""
    rows = spark.createDataFrame([(7, 1, 10), (7, 2, 20), (8, 1, 11), (9, 1, 10), (9, 3, 30)], "key long, node long, mark long")
    fps = [(1, 10, 0), (1, 11, (1 << 60) - 1), (2, 20, 1), (3, 30, 1 << 62)]
    prints = spark.createDataFrame([(n, m, f.to_bytes(8, "little")) for n, m, f in fps], "node long, mark long, fp binary")
    assert {tuple(sorted(e)) for e in S.block_links(rows, 2, 4, False, prints).where("a <> b").collect()} == {(1, 2), (1, 3)}


def test_small_removals_shuffle_no_text(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "", ""), (2, "a b c d e f", "", ""), (3, "g h i j k l m", "", "")], DOCS)
    kept = S.keep_first(docs)
    assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString() and sorted(r.doc_id for r in kept.collect()) == [1, 3]
