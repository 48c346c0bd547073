"""Operators that SQL can't express, against plain versions, and invariants."""

import itertools
import random

import pytest

from lociweave.functions import sequence as S
from lociweave.operators import fragments as P
from lociweave.operators import graph as G
from lociweave.operators import intervals as V
from lociweave.operators import order as O
from lociweave.operators import partition as D
from lociweave.operators import trees as R
from lociweave.plans import registry


def test_greedy_clusters(spark):
    rng = random.Random(1)
    edges = [(a, b, a % 5, b % 5, round(rng.random(), 3)) for a, b in itertools.combinations(range(40), 2) if rng.random() < 0.08]
    of = {n: {n} for e in edges for n in e[:2]}
    for a, b, *_ in sorted(edges, key=lambda e: (-e[4], e[0], e[1])):
        if of[a] is not of[b] and not {x % 5 for x in of[a]} & {x % 5 for x in of[b]}:
            of[a] |= of[b]
            for n in of[b]:
                of[n] = of[a]
    got = {r.node: r.cluster for r in G.greedy_clusters(spark.createDataFrame(edges, "a long, b long, ga long, gb long, score double")).collect()}
    assert got == {n: min(s) for n, s in of.items()}


def test_components_of_long_path_and_star(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 200)]
    got = {r.node: r.component for r in G.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 301)} | {1000 + k: 1000 for k in range(1, 200)}


def test_representatives(spark):
    rng = random.Random(2)
    pairs = [(a, b) for a, b in itertools.combinations(range(30), 2) if rng.random() < 0.15]
    near = {frozenset(p) for p in pairs}
    kept = []
    for n in range(30):
        if not any(frozenset((n, k)) in near for k in kept):
            kept.append(n)
    got = G.greedy_representatives(spark.createDataFrame(pairs, "a long, b long"), spark.range(30).selectExpr("id as node", "id as rank"))
    assert sorted(r.node for r in got.collect()) == kept


@pytest.mark.parametrize("fold_edges", [1, 25, 200_000])
def test_representatives_in_rounds_and_folds(spark, fold_edges):
    rng = random.Random(4)
    n = 60
    ranks = rng.sample(range(1000), n)
    pairs = [(a, b) for a, b in itertools.combinations(range(n), 2) if a // 12 == b // 12 and rng.random() < (0.6 if a < 12 else 0.2)]
    near, kept = {frozenset(p) for p in pairs}, []
    for k in sorted(range(n), key=lambda k: ranks[k]):
        if not any(frozenset((k, x)) in near for x in kept):
            kept.append(k)
    order = spark.createDataFrame(list(enumerate(ranks)), "node long, rank long")
    got = G.greedy_representatives(spark.createDataFrame(pairs, "a long, b long"), order, fold_edges)
    assert sorted(r.node for r in got.collect()) == sorted(kept)


def test_representatives_along_a_path(spark):
    pairs = [(k, k + 1) for k in range(4000)]
    got = G.greedy_representatives(spark.createDataFrame(pairs, "a long, b long"), spark.range(4001).selectExpr("id as node", "id as rank"))
    assert sorted(r.node for r in got.collect()) == list(range(0, 4001, 2))


def test_chains(spark):
    edges = [(1, 2), (2, 3), (7, 5), (5, 6), (6, 7), (9, 8)]
    rows = G.chains(spark.createDataFrame(edges, "a long, b long")).collect()
    by = {}
    for r in sorted(rows, key=lambda r: (r.chain, r.place)):
        by.setdefault(r.chain, []).append(r.node)
    assert by == {1: [1, 2, 3], 5: [5, 6, 7], 8: [8, 9]}


def test_gap_groups(spark):
    rng = random.Random(3)
    rows = [(k % 3, round(rng.random() * 100, 2)) for k in range(200)]
    got = O.gap_groups(spark.createDataFrame(rows, "k long, v double"), "k", "v", 2.0).collect()
    groups = {}
    for r in got:
        groups.setdefault((r.k, r.run, r.grp), []).append(r.v)
    want = []
    for k in range(3):
        start = last = None
        for v in sorted(v for x, v in rows if x == k):
            if start is None or v - last > 2.0 or v - start > 4.0:
                want.append([])
                start = v
            want[-1].append(v)
            last = v
    assert sorted(map(sorted, groups.values())) == sorted(want)


def test_overlap_join_against_all_pairs(spark):
    rng = random.Random(4)
    make = lambda n, at: [(rng.randrange(3), s, s + rng.choice([0, 3, 40, 400]), at + k) for k in range(n) for s in [rng.randrange(-50, 900)]]
    a, b = make(60, 0), make(60, 100)
    schema = "contig long, start long, stop long, name long"
    want = sorted((x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] <= y[2] and y[1] <= x[2])
    for width in (7, 100, 5000):
        got = V.overlap_join(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), width)
        assert sorted((r.l_name, r.r_name) for r in got.collect()) == want


def test_property_circle_ends(spark):
    steps = spark.createDataFrame([(1, 1, True), (2, 1, True), (3, 1, True), (3, 2, False)], "prop long, step long, required boolean")
    evidence = spark.createDataFrame([(1, 1, "prop", 2), (2, 1, "prop", 1), (3, 2, "hit", 50)], "prop long, step long, kind string, query long")
    got = G.property_states(steps, evidence, spark.createDataFrame([(50,)], "query long"))
    assert {r.prop: r.state for r in got.collect()} == {1: "NO", 2: "NO", 3: "PARTIAL"}


def test_newick(spark):
    t = R.newick_table(spark.createDataFrame([(1, "((a:1,b:2)x:3,(c:4,'d e':5):6)r;"), (2, "(a,b);")], "tree long, text string")).collect()
    rows = {(r.tree, r.name): r for r in t if r.name}
    assert rows[1, "d e"].length == 5 and rows[1, "x"].length == 3 and rows[1, "r"].parent is None and len(t) == 10
    e = spark.createDataFrame([(r.node, r.parent, r.name, r.length) for r in t if r.tree == 1], "node long, parent long, name string, length double")
    n = {r.name: r.node for r in t if r.tree == 1}
    got = R.leaf_distances(e, spark.createDataFrame([(n["a"], n["b"]), (n["a"], n["c"]), (n["a"], n["x"])], "a long, b long")).collect()
    assert sorted(r.distance for r in got) == [1.0, 3.0, 14.0]
    assert sorted(r.leaves for r in R.clades(e).collect()) == [["a", "b"], ["a", "b", "c", "d e"], ["c", "d e"]]
    assert R.clade_difference(e, e).count() == 0


@pytest.mark.parametrize("method, text", [("single", "((a:1,b:1):1,c:2);"), ("complete", "((a:1,b:1):2,c:3);"), ("average", "((a:1,b:1):1.5,c:2.5);")])
def test_linkage(spark, method, text):
    d = spark.createDataFrame([("a", "b", 2.0), ("a", "c", 4.0), ("b", "c", 6.0)], "a string, b string, distance double")
    assert R.linkage_newick(spark, d, method) == text


def test_invariants(spark, sf_dir):
    q = registry.queries()
    bsr = q["a01_blast_score_ratio"](spark, sf_dir)
    assert bsr.where("bsr < 0 or bsr > 1 or norm < 0 or norm > 1").count() == 0
    back = bsr.selectExpr("sid as qid", "qid as sid", "bsr as b2")
    assert bsr.join(back, ["qid", "sid"], "left").where("b2 is null or b2 <> bsr").count() == 0
    n = q["w15_cluster_numbering"](spark, sf_dir).agg({"number": "max", "cluster": "count"}).first()
    assert n[0] == n[1]
    r = q["a23_rarefaction"](spark, sf_dir)
    assert r.where("pan <> core + dispensable + `unique`").count() == 0
    for name in sorted(set(q) - set(registry.oracle_sql())):
        assert q[name](spark, sf_dir).limit(5).count() >= 0


def test_alignment_against_full_table():
    from lociweave.operators.synteny import align_ends_free

    def plain(q, s, low=-1e9):
        h = [[low] * (len(s) + 1) for _ in range(len(q) + 1)]
        e, f = [r[:] for r in h], [r[:] for r in h]
        h[0] = [0.0] * (len(s) + 1)
        for i in range(1, len(q) + 1):
            for j in range(len(s) + 1):
                f[i][j] = max(h[i - 1][j] - 5, f[i - 1][j] - 1)
                e[i][j] = max(h[i][j - 1] - 5, e[i][j - 1] - 1) if j else low
                d = h[i - 1][j - 1] + (3 if q[i - 1] == s[j - 1] else -3) if j else low
                h[i][j] = max(d, e[i][j], f[i][j])
        return max(h[-1])

    rng = random.Random(6)
    for _ in range(60):
        s = "".join(rng.choice("ACGT") for _ in range(rng.randint(1, 40)))
        q = list(s[rng.randint(0, 10) : rng.randint(10, 40)]) or ["A"]
        for _ in range(rng.randint(0, 6)):
            k = rng.randrange(len(q))
            q[k : k + 1] = rng.choice([[], ["A"], ["C", "G"], ["T", "T", "T"]])
            q = q or ["A"]
        q = "".join(q)
        score, beg, end, matches = align_ends_free(q, s)
        assert score == plain(q, s)
        assert 1 <= beg <= end + 1 <= len(s) + 1 and 0 <= matches <= min(len(q), len(s))
    assert align_ends_free("GATT", "AAGATTCC") == (12.0, 3, 6, 4)


def test_plateaus_and_overlap_table(spark):
    from lociweave.operators import synteny as Y

    values = [(1, k, v) for k, v in enumerate([10.0, 10.5, 9.8, 20.0, 21.0, 5.0])]
    got = Y.smoothed_plateaus(spark.createDataFrame(values, "contig long, pos long, value double")).orderBy("pos").collect()
    assert [r.level for r in got] == [10.5, 10.5, 10.5, 21.0, 21.0, 5.0]
    rows = [(1, 0, 9, 1, "A"), (1, 1, 10, 2, "A"), (1, 0, 10, 3, "B"), (1, 2, 9, 4, "C"), (1, 100, 110, 5, "C")]
    t = Y.overlap_table(spark.createDataFrame(rows, "contig long, start long, stop long, name long, species string"), ["A", "B", "C"], 7).collect()
    assert {r.name: (r.B, r.C) for r in t} == {1: (3, 4), 2: (None, None)}


def test_fragment_groups(spark):
    # 1 2 3 follow each other as pieces of query 9; 4 is too far off; 5 and 6 overlap too much; 7 and 8 have more whole matches than links
    places = [(n, 0, p, size) for n, p, size in ((1, 1, 5), (2, 2, 9), (3, 4, 9), (4, 9, 3), (5, 20, 4), (6, 21, 4), (7, 30, 4), (8, 31, 4))]
    hits = [(9, 1, 1, 10), (9, 2, 11, 20), (9, 3, 21, 30), (9, 4, 31, 40), (10, 5, 1, 10), (10, 6, 3, 11), (11, 7, 1, 10), (11, 8, 11, 20)]
    got = P.fragment_groups(
        spark.createDataFrame(hits, "qid long, sid long, start int, stop int"),
        spark.createDataFrame(places, "feat long, contig int, pos int, length int"),
        spark.createDataFrame([(1, 2), (7, 3)], "feat long, n int"),
    )
    assert {(r.feat, r.group, r.kept) for r in got.collect()} == {(1, 1, False), (2, 1, True), (3, 1, False)}


def test_until_stable_peels_to_the_core(spark):
    edges = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (6, 7)]

    def step(e):
        from pyspark.sql import functions as F

        ends = e.select(F.explode(F.array("a", "b")).alias("n")).groupBy("n").count().where("count > 1").select("n")
        return e.join(ends.withColumnRenamed("n", "a"), "a", "left_semi").join(ends.withColumnRenamed("n", "b"), "b", "left_semi").select("a", "b")

    assert {tuple(r) for r in G.until_stable(spark.createDataFrame(edges, "a long, b long"), step).collect()} == {(1, 2), (2, 3), (3, 1)}


def test_introduced_stops(spark):
    from pyspark.sql import functions as F

    def plain(seq):
        back = seq[::-1].translate(str.maketrans("ACGT", "TGCA"))
        out = []
        for text, sign in ((seq, 1), (back, -1)):
            for f in range(3):
                if f == 1:
                    continue  # not open before
                at = next((i for i in range(f, len(seq) - 3, 3) if text[i : i + 3] in ("TAA", "TAG", "TGA")), None)
                if at is not None:
                    out.append((sign * (f + 1), at))
        return out

    rng = random.Random(4)
    seqs = ["".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 60))) for _ in range(60)] + ["ATGTAA", "TAAA", "TAA", ""]
    opens = F.array(*(F.lit(f % 3 != 1) for f in range(6)))
    df = spark.createDataFrame(list(enumerate(seqs)), "id int, seq string").select("id", S.introduced_stops(F.col("seq"), opens).alias("s"))
    assert {r.id: [tuple(x) for x in r.s] for r in df.collect()} == {k: plain(q) for k, q in enumerate(seqs)}


def test_consensus_lines_and_numbering(spark):
    chains = spark.createDataFrame([(1, 2, 5), (1, 1, 9), (2, 1, 7)], "chain long, place int, node long")
    assert {tuple(r) for r in P.consensus_lines(chains).collect()} == {(1, 2, "9,5"), (2, 1, "7")}
    rows = O.numbered(spark.createDataFrame([(x,) for x in random.Random(5).sample(range(10_000), 3000)], "x long"), "x").collect()
    assert [r.k for r in sorted(rows, key=lambda r: r.x)] == list(range(1, 3001))


def test_median_partition(spark):
    rng = random.Random(6)
    near = {}
    for a, b in itertools.combinations(range(40), 2):
        if rng.random() < 0.95:
            near[a, b] = near[b, a] = round(rng.random(), 3)

    def plain(group, name):
        if not group:
            return []
        m = group[len(group) // 2]
        out = [(m, name)]
        rest = sorted((near.get((m, x), 1.0), k, x) for k, x in enumerate(group) if x != m)
        rest = [r for r in rest if r[0] > 0.05]
        groups, start, last = [], None, None
        for d, _, x in rest:
            if start is None or d - start > 0.1 or d - last > 0.05:
                groups.append([])
                start = d
            groups[-1].append(x)
            last = d
        for k, g in enumerate(groups, 1):
            out += plain(g, f"{name}_{k}")
        return out

    pairs = spark.createDataFrame([(a, b, d) for (a, b), d in near.items() if a < b], "a long, b long, distance double")
    got = D.median_partition(spark.range(40).selectExpr("id as node", "id as place"), pairs, 0.05)
    assert sorted(map(tuple, got.collect())) == sorted(plain(list(range(40)), "1"))


def test_spaced_representatives(spark):
    even = [("a", k, k / 10) for k in range(1, 11)]  # slices of two: the 2nd, 4th, ... node
    close = [("b", k, 0.5 + k / 1000) for k in range(10)] + [("b", 99, 0.9), ("b", 100, 0.01)]  # only one of the close ones, and the far one
    rows = D.spaced_representatives(spark.createDataFrame(even + close, "type string, node long, distance double"), 5, 0.05).collect()
    assert sorted(r.node for r in rows if r.type == "a") == [2, 4, 6, 8, 10]
    assert sorted(r.node for r in rows if r.type == "b") == [1, 99]


def test_clusters_and_chains_of_every_shape(spark):
    """Merging by rounds against the ordered fold, pointers of doubling reach against a walk."""
    rng = random.Random(11)
    edges = []
    for _ in range(120):
        a, b = rng.sample(range(45), 2)
        edges.append((min(a, b), max(a, b), min(a, b) % 9, max(a, b) % 9, rng.randint(1, 30) / 30))
    edges = list({e[:2]: e for e in edges}.values())
    of = {n: n for e in edges for n in e[:2]}
    sets = {n: {n % 9} for n in of}
    for a, b, *_ in sorted(edges, key=lambda e: (-e[4], e[0], e[1])):
        x, y = sorted((of[a], of[b]))
        if x != y and not sets[x] & sets[y]:
            sets[x] |= sets.pop(y)
            of = {n: x if c == y else c for n, c in of.items()}
    got = {r.node: r.cluster for r in G.greedy_clusters(spark.createDataFrame(edges, "a long, b long, ga long, gb long, score double")).collect()}
    assert got == of
    paths, walks = [], set()
    at = 1000
    for n in (2, 3, 5, 19, 4, 9):
        nodes = list(range(at, at + n))
        rng.shuffle(nodes)
        circle = n in (4, 9)
        paths += list(zip(nodes, nodes[1:])) + ([(nodes[-1], nodes[0])] if circle else [])
        if circle:
            k = nodes.index(at)
            nodes = nodes[k:] + nodes[:k]
            nodes = nodes if nodes[1] < nodes[-1] else [nodes[0], *nodes[:0:-1]]
        elif nodes[0] > nodes[-1]:
            nodes.reverse()
        walks |= {(at, k + 1, v) for k, v in enumerate(nodes)}
        at += 100
    assert {tuple(r) for r in G.chains(spark.createDataFrame(paths, "a long, b long")).collect()} == walks


def test_deep_tree(spark):
    t = spark.range(1, 301).selectExpr("id as node", "if(id > 1, id - 1, null) as parent", "1.0D as length")
    assert R.ancestors(t).count() == 300 * 301 // 2


def test_unsettled_rounds_are_an_error(spark):
    import pytest

    with pytest.raises(RuntimeError):
        G.until_stable(spark.range(1), lambda d: d.selectExpr("id + 1 as id"), 3)


def test_spaced_representatives_against_a_walk(spark):
    rng = random.Random(3)
    rows = [(t, k, round(rng.random() ** 2, 3)) for t in "abcde" for k in range(rng.randint(1, 60))]
    for quota, gap in ((5, 0.05), (9, 0.01), (40, 0.002)):
        want = set()
        for t in "abcde":
            v = sorted((d, k) for x, k, d in rows if x == t and d > gap)
            last, s = 0.0, 1
            for i, (d, k) in enumerate(v):
                if i >= min(max(int(s * len(v) / quota + 0.499) - 1, 0), len(v) - 1) and d - last > gap:
                    want.add((t, k, d))
                    last = d
                    while int(s * len(v) / quota + 0.499) - 1 <= i:
                        s += 1
        got = D.spaced_representatives(spark.createDataFrame(rows, "type string, node long, distance double"), quota, gap)
        assert {tuple(r) for r in got.collect()} == want


def test_walks_from_anchors(spark):
    rng = random.Random(5)
    places = [(c * 100 + p, c, p, rng.choice((1, -1))) for c in range(4) for p in range(1, 31)]
    at = {i: (c, p, o) for i, c, p, o in places}
    pairs = {(q, s): rng.random() < 0.1 for q in at for s in at if at[q][0] != at[s][0] and rng.random() < 0.12}
    of = {(*at[q][:2], *at[s][:2]): (q, s) for q, s in pairs}
    want = set()
    for (q, s), start in pairs.items():
        for d in (1, -1) if start else ():
            (qc, qp, qo), (sc, sp, so) = at[q], at[s]
            while True:
                tries = [(a, b) for a, b in P.WALK_STEPS if b == 1 or 1 <= qp + 3 * d <= 30]
                met = [x for a, b in tries if (x := (qc, qp + d * a, sc, sp + d * qo * so * b)) in of]
                if not met or pairs[of[met[0]]]:
                    break
                want.add(of[met[0]])
                _, qp, _, sp = met[0]
    rel = spark.createDataFrame([(q, s, a) for (q, s), a in pairs.items()], "qid long, sid long, a boolean")
    got = P.extended_anchors(rel, spark.createDataFrame(places, "id long, contig long, pos long, orient int"), rel["a"]).collect()
    assert len(got) == len(pairs) and {(r.qid, r.sid) for r in got if r.extended} == want


def _spread(parents):
    """Distances between all nodes of {node: (parent, length)}."""
    near = {n: [] for n in parents}
    for n, (p, length) in parents.items():
        if p is not None:
            near[n].append((p, length))
            near[p].append((n, length))
    out = {}
    for a in near:
        todo = [(a, None, 0.0)]
        while todo:
            n, came, d = todo.pop()
            out[a, n] = d
            todo += [(m, n, d + length) for m, length in near[n] if m != came]
    return out


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_new_roots_keep_distances(spark, seed):
    rng = random.Random(seed)
    parents = {1: (None, 0.0)} | {n: (rng.randint(max(1, n - 6), n - 1), float(rng.randint(1, 20))) for n in range(2, 31)}
    tree = spark.createDataFrame([(n, p, str(n), length) for n, (p, length) in parents.items()], "node long, parent long, name string, length double")
    before = _spread(parents)
    node, above = R.midpoint(tree)
    new = {r.node: (r.parent, r.length) for r in R.reroot(tree, node, above, 0).collect()}
    after = _spread(new)
    assert [n for n, (p, _) in new.items() if p is None] == [0]
    assert all(after[a, b] == before[a, b] for a, b in before if a in new and b in new)
    assert sorted((after[0, n] for n in new), reverse=True)[0] == max(before.values()) / 2


def test_trimmed_intervals(spark):
    rng = random.Random(7)
    rows = [(c, s, s + rng.randint(0, 30), f"n{c}_{k:02}", rng.randint(0, 3)) for c in range(3) for k in range(25) for s in [rng.randint(0, 150)]]
    want = set()
    for c in range(3):
        owner = {p: min((k, s, n) for _, s, e, n, k in mine if s <= p <= e) for mine in [[r for r in rows if r[0] == c]] for p in range(200) if any(s <= p <= e for _, s, e, _, _ in mine)}
        for _, _, _, n, k in (r for r in rows if r[0] == c):
            runs = [list(g) for _, g in itertools.groupby(enumerate(p for p in sorted(owner) if owner[p][2] == n), lambda x: x[1] - x[0])]
            if runs:
                best = max(runs, key=lambda g: (len(g), -g[0][1]))
                want.add((c, n, k, best[0][1], best[-1][1]))
    got = V.trim_by_priority(spark.createDataFrame(rows, "contig long, start long, stop long, name string, kind int"), "kind", 10)
    assert {tuple(r) for r in got.collect()} == want


def test_subset_pairs_of_many_equal_sets(spark, monkeypatch):
    from lociweave.operators import sets as U

    monkeypatch.setattr(U, "BLOCK", 4)
    rng = random.Random(2)
    sets = {n: frozenset(rng.sample(range(6), rng.randint(1, 4))) for n in range(40)} | {100 + n: frozenset((1, 2, 3)) for n in range(30)}
    df = spark.createDataFrame([(n, x) for n, s in sets.items() for x in s] + [(100, None)], "set long, x long")
    got = U.subset_pairs(df)
    assert "flatten" not in got._jdf.queryExecution().toString()  # no row holds all pairs of the sets of an element
    assert sorted(map(tuple, got.collect())) == sorted((a, b) for a in sets for b in sets if a not in (b, 100) and sets[a] <= sets[b])


def test_cliques(spark):
    rows = [(a, b, 9.0, True) for a, b in itertools.permutations((1, 2, 3), 2)]
    rows += [(a, b, 8.0, True) for a, b in itertools.permutations((4, 5, 6), 2)] + [(4, 7, 3.0, False)]
    rows += [(a, b, 7.0, True) for a, b in itertools.permutations((10, 11, 12), 2)] + [(11, 13, 7.5, False)]
    rows += [(20, 21, 5.0, True), (21, 20, 5.0, True), (1, 1, 10.0, True)]
    got = {r.qid: (r.top, r.whole) for r in G.cliques(spark.createDataFrame(rows, "qid long, sid long, score double, mutual boolean")).collect()}
    assert got == {1: (3, 3), 2: (3, 3), 3: (3, 3), 4: (3, 0), 5: (3, 0), 6: (3, 0), 10: (0, 0), 11: (0, 0), 12: (0, 0), 20: (0, 0), 21: (0, 0)}


def test_cliques_of_classes(spark):
    """Matches between classes of nodes say what all pairs of their nodes would."""
    rng = random.Random(5)
    of = {n: rng.randint(0, 11) for n in range(60)}
    links = [(a, b, -float(abs(a - b)), abs(a - b) <= 1) for a in range(12) for b in range(12) if a // 3 == b // 3 or abs(a - b) == 1]
    links = [x for x in links if (x[0], x[1]) not in ((7, 7), (0, 1))]
    wide = [(q, s, score, mutual) for a, b, score, mutual in links for q in of for s in of if of[q] == a and of[s] == b and q != s]
    x = "qid long, sid long, score double, mutual boolean"
    want = {tuple(r) for r in G.cliques(spark.createDataFrame(wide, x)).collect()}
    got = {tuple(r) for r in G.cliques(spark.createDataFrame(links, x), spark.createDataFrame(list(of.items()), "node long, class long")).collect()}
    assert got == want and any(r[1] for r in want)


@pytest.mark.parametrize("fold_edges", [3, 40, 200_000])
def test_greedy_clusters_in_rounds_and_folds(spark, fold_edges):
    """Components above the bound go in rounds, those that come out of them in folds: the same merges."""
    rng = random.Random(7)
    edges = [(a, b, a % 7, b % 7, round(rng.random(), 2)) for a, b in itertools.combinations(range(70), 2) if rng.random() < 0.05]
    of = {n: {n} for e in edges for n in e[:2]}
    for a, b, *_ in sorted(edges, key=lambda e: (-e[4], e[0], e[1])):
        if of[a] is not of[b] and not {x % 7 for x in of[a]} & {x % 7 for x in of[b]}:
            both = of[a] | of[b]
            for n in both:
                of[n] = both
    got = {r.node: r.cluster for r in G.greedy_clusters(spark.createDataFrame(edges, "a long, b long, ga long, gb long, score double"), fold_edges, 2).collect()}
    assert got == {n: min(s) for n, s in of.items()}


def test_greedy_clusters_of_a_long_falling_path(spark):
    n = 5000
    edges = [(k, k + 1, k % 25, (k + 1) % 25, 1 - k / n) for k in range(n)]
    got = {r.node: r.cluster for r in G.greedy_clusters(spark.createDataFrame(edges, "a long, b long, ga long, gb long, score double")).collect()}
    assert got == {k: k - k % 25 for k in range(n + 1)}


def test_components_with_hubs_that_are_split(spark, monkeypatch):
    monkeypatch.setattr(G, "TASK_ROWS", 0)
    edges = [(k, k + 1) for k in range(40)] + [(1000, 1000 + k) for k in range(1, 600)]
    got = {r.node: r.component for r in G.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {1000 + k: 1000 for k in range(1, 600)}


def test_annotation_difference_reads_its_sides_once(spark, sf_dir):
    """Intervals that come out of joins are written once, and all that reads them, or what they have in common, reads those tables."""
    from lociweave.operators import intervals as V
    from lociweave.plans import intervals as Q

    got = V.annotation_difference(*(Q.side(spark, sf_dir, k) for k in "AR"), 200)
    assert got.inputFiles() and all("/settled-" in f for f in got.inputFiles())


def test_annotation_difference_shuffles_best_mates_not_pairs(spark):
    """Long and short intervals, piles of equal shares and sides without a mate; the best of each name is an aggregation, not a window over all pairs."""
    from lociweave.operators import intervals as V

    rng = random.Random(21)
    sides = []
    for k in range(2):
        rows = [(n % 3, start, start + rng.choice((9, 9, 30, 300)), 1000 * k + n, rng.choice((1, -1))) for n in range(70) for start in [10 * rng.randrange(40)]]
        sides.append(rows + [(5 + k, 0, 9, 1000 * k + 90, 1)])
    share = {}
    for c, a0, a1, x, _ in sides[0]:
        for _, b0, b1, y, _ in (r for r in sides[1] if r[0] == c and a0 <= r[2] and r[1] <= a1):
            o = min(a1, b1) - max(a0, b0) + 1
            if (v := round((o / (a1 - a0 + 1) + o / (b1 - b0 + 1)) / 2, 9)) >= 0.5:
                share[x, y] = v
    best = [{n: min((-v, p[1 - k]) for p, v in share.items() if p[k] == n)[1] for n in {p[k] for p in share}} for k in (0, 1)]
    mutual = {x: y for x, y in best[0].items() if best[1][y] == x}
    old, new = ({r[3]: r for r in side} for side in sides)
    want = [(x, None, "REMOVED") for x in old if x not in mutual] + [(None, y, "NEW") for y in new if y not in mutual.values()]
    for x, y in mutual.items():
        (_, a0, a1, _, s), (_, b0, b1, _, t) = old[x], new[y]
        kind = "SAME" if (a0, a1) == (b0, b1) else "BOTH" if a0 != b0 and a1 != b1 else "DIFF_5P" if a0 != b0 else "DIFF_3P"
        want.append((x, y, kind if s == t else "INVERT" if kind == "SAME" else f"{kind}_INVERT"))
    tables = [spark.createDataFrame(side, "contig long, start long, stop long, name long, orient int") for side in sides]
    got = V.annotation_difference(*tables, 20)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    pairs = V.mutual_overlaps(*tables, 20)
    assert {(r.l_name, r.r_name): r.share for r in pairs.collect()} == {p: share[p] for p in mutual.items()}
    assert not any("Window" in df._jdf.queryExecution().toString() for df in (got, pairs))


def test_overlap_table_is_one_fold_over_sorted_candidates(spark):
    from lociweave.operators import intervals as V
    from lociweave.operators import synteny as Y

    rng = random.Random(13)
    rows = []
    for n in range(400):
        start = rng.randrange(600)
        rows.append((n % 7, start, start + rng.randrange(5, 40), n, rng.choice("ABC")))
    df = spark.createDataFrame(rows, "contig long, start long, stop long, name long, species string")
    want = {}
    for contig in range(7):
        used = set()
        for _, start, stop, name, _ in sorted((r for r in rows if r[0] == contig and r[4] == "A"), key=lambda r: (r[1], r[2], r[3])):
            found, near = {}, []
            for _, s, e, other, kind in (r for r in rows if r[0] == contig and r[4] != "A"):
                share = round((min(stop, e) - max(start, s) + 1) / max(stop - start + 1, e - s + 1), 9)
                if share >= 0.5:
                    near.append((-share, other, kind))
            for _, other, kind in sorted(near):
                if kind not in found and other not in used:
                    found[kind] = other
                    used.add(other)
            if near:
                want[name] = (found.get("B"), found.get("C"))
    table = Y.overlap_table(df, ["A", "B", "C"], 4)
    assert {r.name: (r.B, r.C) for r in table.collect()} == want
    assert "FlatMapGroupsInPandas" not in table._jdf.queryExecution().toString()  # a group of pandas for each contig took most of the time
    assert V.measured(df, 4)[1] > 30  # a bin is as wide as the intervals are long, not ten of them for each


def test_clade_support_keeps_a_row_a_node(spark, monkeypatch):
    rng = random.Random(16)
    trees = []
    for k in range(5):
        trees += [(k, n, None if n == 1 else rng.randrange(max(1, n - 4), n), f"n{n % 50}", 1.0) for n in range(1, 61)]
    leaves = {}
    for k in range(5):
        up = {n: p for t, n, p, *_ in trees if t == k}
        below = {}
        for n in set(up) - set(up.values()):
            at = up[n]
            while at is not None:
                below.setdefault(at, []).append(f"n{n % 50}")
                at = up[at]
        leaves[k] = {n: tuple(sorted(v)) for n, v in below.items()}
    want = {n: sum(c in leaves[k].values() for k in range(1, 5)) * 25.0 for n, c in leaves[0].items()}
    wrote, settle = [], R.settle
    monkeypatch.setattr(R, "settle", lambda df, **k: wrote.append(settle(df, **k)) or wrote[-1])
    df = spark.createDataFrame(trees, "tree int, node long, parent long, name string, length double")
    got = R.clade_support(df.where("tree = 0").drop("tree"), df.where("tree > 0"))
    assert {r.node: r.support for r in got.collect()} == want
    assert max(t.count() for t in wrote) <= 240  # never a row for each node and ancestor


@pytest.mark.parametrize("name", ["resolve_conflicts", "suppress_competitors"])
def test_long_intervals_lie_in_few_bins(spark, monkeypatch, name):
    from lociweave.operators import regions as Z

    rng = random.Random(25)
    rows = [(n % 5, s, s + rng.randrange(900, 1100), n, n % 4, n % 17, n % 90, n % 3 + 1, n % 3 == 0) for n in range(200) for s in [rng.randrange(3000)]]
    df = spark.createDataFrame(rows, "contig long, start long, stop long, name long, cluster long, bits long, pid long, size long, best boolean")
    module = V if name == "resolve_conflicts" else Z
    run = lambda width: sorted(map(tuple, (V.resolve_conflicts(df, ["bits"], width, 30) if module is V else Z.suppress_competitors(df, width)).collect()))
    widths, join = [], V.overlap_join
    monkeypatch.setattr(module, "overlap_join", lambda a, b, width: widths.append(width) or join(a, b, width))
    assert run(200) == run(100_000)  # the width changes no row
    assert widths[0] > 1800 and widths[1] == 100_000  # bins of 200 would hold an interval six times


def test_trimming_sweeps_contigs_without_pairs(spark):
    rng = random.Random(23)
    rows = [(c, s, s + rng.randint(-2, 60), n, rng.choice([None, 0, 1, 2])) for c in range(4) for n, s in enumerate(rng.randint(0, 300) for _ in range(60))] + [(5, 1, 3, 0, 1), (None, 1, 3, 0, 1)]
    want = set()
    for c in range(6):
        mine = [r for r in rows if r[0] == c]
        owner = {p: min(((k is not None, k or 0), s, n) for _, s, e, n, k in mine if s <= p <= e)[2] for p in range(400) if any(s <= p <= e for _, s, e, _, _ in mine)}
        for _, _, _, n, k in mine:
            runs = [list(g) for _, g in itertools.groupby(enumerate(p for p in sorted(owner) if owner[p] == n), lambda x: x[1] - x[0])]
            if runs:
                best = max(runs, key=lambda g: (len(g), -g[0][1]))
                want.add((c, n, k, best[0][1], best[-1][1]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = V.trim_by_priority(spark.createDataFrame(rows, "contig long, start long, stop long, name long, kind int"), "kind", 10)
        assert {tuple(r) for r in got.collect()} == want
        assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_reciprocal_evaluates_best_once(spark):
    from lociweave.operators import hits as H

    rng = random.Random(19)
    pairs = [(rng.randrange(12), rng.randrange(12), n) for n in range(60)] + [(None, 1, 60), (3, None, 61)]
    known = {p[:2] for p in pairs if None not in p}
    got = H.reciprocal(spark.createDataFrame(pairs, "qid long, sid long, n long"))
    assert sorted(map(tuple, got.collect())) == sorted(p for p in pairs if p[:2] in known and p[1::-1] in known)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_medoids_evaluate_ratios_once(spark, sf_dir, monkeypatch):
    from lociweave.plans import hits as P2

    seen, settle = [], P2.settle
    monkeypatch.setattr(P2, "settle", lambda df: seen.append(settle(df)) or seen[-1])
    plan = registry.queries()["t04_medoids"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert len(seen) == 1 and "l_partkey" not in plan  # members and scores are read from what is written


@pytest.mark.parametrize("split", [0, 1, 3])
def test_representatives_need_no_components_while_rounds_settle_all(spark, monkeypatch, split):
    rng = random.Random(22)
    pairs = [(a, 100 + b) for a in range(30) for b in range(40) if rng.random() < 0.2]  # settled by one round
    chain = [(n, n + 1) for n in range(200, 240)]
    called, components = [], G.components
    monkeypatch.setattr(G, "components", lambda e: called.append(1) or components(e))
    monkeypatch.setattr(G, "SPLIT", split)
    for edges in (pairs, pairs + chain):
        near = {}
        for a, b in edges:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
        kept = set()
        for n in sorted(near):
            if not near[n] & kept:
                kept.add(n)
        order = spark.createDataFrame([(n, n) for n in near], "node long, rank long")
        got = G.greedy_representatives(spark.createDataFrame(edges, "a long, b long"), order, 5)
        assert {r.node for r in got.collect()} == kept
        assert split == 0 or edges is not pairs or not called


def _partitioned_by(plan):
    """Keys of each shuffle in the text of a plan."""
    import re

    return re.findall(r"hashpartitioning\(([^)]*)\)", plan._jdf.queryExecution().executedPlan().toString())


def test_members_are_dealt_by_cluster_before_they_are_repeated(spark, sf_dir):
    keys = _partitioned_by(registry.queries()["a23_rarefaction"](spark, sf_dir))
    assert any(k.startswith("cluster") and "combo" not in k and "genome" not in k for k in keys)
    assert not any("combo" in k and "cluster" in k for k in keys)


def test_sequences_are_shuffled_not_their_kmers(spark, sf_dir):
    keys = _partitioned_by(registry.queries()["x07_canonical_kmers"](spark, sf_dir))
    assert len(keys) == 1 and keys[0].startswith("id")


def test_states_are_dealt_into_more_tasks_as_they_grow(spark, monkeypatch):
    monkeypatch.setattr(G, "SPREAD_ROWS", 10)
    edges = spark.createDataFrame([(n, n // 2 or None) for n in range(1, 51)], "node long, parent long")
    states = spark.createDataFrame([(n, k, (n * k) % 3 == 0) for n in range(1, 51) for k in range(4)], "node long, character int, present boolean")
    got = R.gains_and_losses(edges, states)
    now = lambda n, k: (n * k) % 3 == 0
    assert {tuple(r) for r in got.collect()} == {(n, sum(now(n, k) and not now(n // 2, k) for k in range(4)), sum(now(n // 2, k) and not now(n, k) for k in range(4))) for n in range(2, 51)}
    assert "20), REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()  # 200 states, 10 in a task


def test_orders_are_dealt_into_more_tasks_as_they_grow(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(G, "SPREAD_ROWS", 500)
    tasks = -(-spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() // 500)
    plan = registry.queries()["j11_cluster_member_attributes"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert tasks > 8 and plan.count(f"{tasks}), REPARTITION_BY_NUM") == 2
