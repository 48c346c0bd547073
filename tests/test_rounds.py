"""Operators that go in rounds, against plain versions."""

import itertools
import random
import re
from collections import Counter, defaultdict, namedtuple

import pytest
from pyspark.sql import functions as F

from lociweave.functions.sequence import IDENTITY_BANDS, LENGTH_BANDS
from lociweave.operators import bubbles as B
from lociweave.operators import consistency as C
from lociweave.operators import fragments as P
from lociweave.operators import graph as G
from lociweave.operators import hierarchy as H
from lociweave.operators import linkage as L
from lociweave.operators import partition as D
from lociweave.operators import walks as K
from lociweave.plans import rounds as Q
from lociweave.plans.standin import features

N = namedtuple("N", "cluster side kind neighbour end frequency distance")
I = namedtuple("I", "cluster prevalence core")  # noqa: E741


def band(value, bands):
    return next((score for least, score in bands if value >= least), 0.0)


def plain_rounds(choices, clusters, neighbours, circular, schedule=C.ROUNDS):
    """Contig by contig, column by column, with all scores computed anew in each round."""
    info = {r.cluster: r for r in clusters}
    table = defaultdict(list)
    for r in neighbours:
        table[r.cluster, r.kind, r.side].append(r)
    state = defaultdict(lambda: defaultdict(lambda: defaultdict(dict)))  # contig, (place, sub), choice, part
    for r in choices:
        if r.cluster in info:
            state[r.contig][r.place, 0][r.choice][r.part] = r

    def near_of(contig, cols, wraps):
        out = {}
        keys = sorted(cols)
        held = {k: {(r.cluster, r.inverted) for parts in cols[k].values() for r in parts.values()} for k in keys}
        cores = [i for i, k in enumerate(keys) if any(info[c].core for c, _ in held[k])]
        n, m = len(keys), len(cores)
        for i, k in enumerate(keys):
            for side in (-1, 1):
                found = {}
                for o in range(1, min(3, n) + 1):
                    j = i + side * o
                    if not wraps and not 0 <= j < n:
                        continue
                    for c, inv in sorted(held[keys[j % n]]):
                        found.setdefault(("near", c), (inv, o))
                first = sum(c < i for c in cores) if side < 0 else sum(c <= i for c in cores) - 1
                for o in range(1, min(3, m) + 1):
                    q = first + side * o
                    if not wraps and not 0 <= q < m:
                        continue
                    j = cores[q % m]
                    away = (j - i) * side
                    for c, inv in sorted(held[keys[j]]):
                        if info[c].core:
                            found.setdefault(("core", c), (inv, away if away > 0 else away + n))
                out[k, side] = found
        return out

    def side_score(r, side, seen, mates):
        total = 0.0
        for kind in ("near", "core"):
            best = {True: None, False: None}
            for of in (5, 3):
                forward = of == (5 if r.inverted != (side < 0) else 3)
                for option in table[r.cluster, kind, of]:
                    for known, own in ((seen, False), (mates, True)):
                        key = (kind, option.neighbour) if not own else option.neighbour
                        if key not in known or own and not forward:
                            continue
                        turned, distance = known[key]
                        value = option.frequency / 2 if (turned != (side < 0)) == (option.end == 5) else option.frequency
                        fits = 0.0
                        if kind == "core":
                            off = abs(option.distance - distance) / option.distance
                            fits = 0.01 if off > 0.99 else 1 - off
                        mine = (value + fits, fits, value)
                        best[forward] = max(best[forward] or mine, mine)
            yield max(best[True][0] if best[True] else 0.0, best[False][2] / 2 + best[False][1] if best[False] else 0.0)
        return total

    median, threshold, minimum = 0.0, 4.0, 3.0
    for n_round, rule in enumerate(schedule):
        hits = Counter(r.cluster for cols in state.values() for col in cols.values() for parts in col.values() for r in parts.values())
        bests, seconds, new, out = [], [], defaultdict(lambda: defaultdict(lambda: defaultdict(dict))), []
        for contig, cols in state.items():
            seen = near_of(contig, cols, contig in circular)
            for key, col in cols.items():
                ranked = []
                for choice, parts in col.items():
                    mates = {}
                    if len(parts) > 1:
                        for _, r in sorted(parts.items()):
                            mates[r.cluster] = (r.inverted, 1)
                    rated = []
                    for p, r in parts.items():
                        (a, b), (c, d) = (tuple(side_score(r, s, seen[key, s], mates)) for s in (-1, 1))
                        context = round(a + b + c + d, 9)
                        i = info[r.cluster]
                        homology = float(i.core) + i.prevalence + 1 / hits[r.cluster] + band(r.pid / 100, IDENTITY_BANDS) + band(r.share, LENGTH_BANDS)
                        rated.append((round(context + homology, 9), -p, i.core, context, r.pid))
                    top = max(rated)
                    ranked.append((-top[0], -round(sum(x[0] - median for x in rated), 9), choice, top, len(parts)))
                ranked.sort(key=lambda x: x[:3])
                score, top, size = -ranked[0][0], ranked[0][3], ranked[0][4]
                if not top[2]:
                    bests.append(score)
                    seconds += [-ranked[1][0]] if len(ranked) > 1 else []
                kept = [ranked[0]]
                if not rule.final:
                    kept += [x for x in ranked[1:] if -x[0] >= rule.fraction * score and not (rule.plain and (x[4] > 1 or size > 1))]
                sure = rule.final and (top[2] or score > minimum + 1 or top[3] >= 1 and top[4] >= 90)
                status = 1 if score > threshold else int(sure) if score > minimum else -1
                if status < 0:
                    continue
                for x in kept:
                    for p, r in col[x[2]].items():
                        out.append((contig, *key, p, r.cluster, -x[0], status, r.inverted))
                        if len(kept) == 1 and x[4] > 1:
                            new[contig][key[0], p][x[2]][0] = r
                        else:
                            new[contig][key][x[2]][p] = r
        if n_round == 0:
            at = lambda xs, s: sorted(xs)[len(xs) // s] if xs else 0.0
            median, threshold = at(bests, 2), (at(bests, 4) + at(seconds, 2)) / 2
        state = new
    return sorted(out), (median, threshold)


def test_neighbour_rounds(spark, sf_dir):
    tables = Q.consistency_input(spark, sf_dir)
    got = sorted((r.contig, r.place, r.sub, r.part, r.cluster, r.score, r.status, r.inverted) for r in C.neighbour_rounds(*tables).collect())
    choices, clusters, neighbours = (t.collect() for t in tables[:3])
    want, _ = plain_rounds(choices, clusters, neighbours, {r.contig for r in tables[3].collect()})
    assert [r[:5] + r[6:] for r in got] == [r[:5] + r[6:] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want])
    assert len({r[2] for r in got}) > 1 and any(len(r) for r in got)


def test_scoring_meets_a_pair_of_clusters_once_and_does_not_sort(spark):
    row = lambda side, end, frequency, kind="near", distance=None: ("a", side, kind, "b", end, frequency, distance)
    rows = [row(5, 3, 0.5), row(5, 5, 0.25), row(3, 3, 1.0), row(5, 3, 0.75, "core", 2.0)]
    pairs = C.by_pair(spark.createDataFrame(rows, "cluster string, side int, kind string, neighbour string, end int, frequency double, distance double"))
    got = {r.kind: r for r in pairs.collect()}
    assert len(got) == pairs.count() == 2
    assert (got["near"].f53, got["near"].f55, got["near"].f33, got["near"].f35, got["core"].f53, got["core"].d53) == (0.5, 0.25, 1.0, None, 0.75, 2.0)
    schema = "contig long, idx long, cluster string, inverted boolean, core boolean, held long, cores long, n long, m long, circular boolean"
    placed = spark.createDataFrame([(1, 0, "a", False, True, 1, 1, 3, 2, False), (1, 1, "b", True, False, 0, 1, 3, 2, False), (1, 2, "b", None, True, 1, 2, 3, 2, False)], schema)
    near, core = C._observed(placed)
    assert not any("SortAggregate" in x._jdf.queryExecution().executedPlan().toString() for x in (near, core))
    assert sorted(r[1:] for r in near.collect()) == [(0, 1, "b", True, 1), (1, -1, "a", False, 1), (1, 1, "b", None, 1), (2, -1, "a", False, 2), (2, -1, "b", True, 1)]
    assert sorted(r[1:] for r in core.collect()) == [(0, 1, "b", None, 2), (1, -1, "a", False, 1), (1, 1, "b", None, 1), (2, -1, "a", False, 2)]


def test_rounds_meet_clusters_by_number(spark, monkeypatch):
    """Within the rounds a cluster is a number; names that sort otherwise, are in no column or only neighbours change nothing."""
    kinds, scored = [], C.scored
    monkeypatch.setattr(C, "scored", lambda state, hits, pairs, circular: kinds.append([state.schema["cluster"].dataType.simpleString(), *(pairs.schema[c].dataType.simpleString() for c in ("cluster", "neighbour"))]) or scored(state, hits, pairs, circular))
    choices = spark.createDataFrame([(1, k, 0, 0, c, False, 95.0, 0.9) for k, c in enumerate(["b", "a", "é"])], "contig long, place long, choice int, part int, cluster string, inverted boolean, pid double, share double")
    clusters = spark.createDataFrame([("é", 0.9, True), ("a", 0.8, True), ("b", 1.0, True), ("unused", 1.0, False)], "cluster string, prevalence double, core boolean")
    neighbours = spark.createDataFrame([("a", 3, "near", "b", 5, 0.5, None), ("b", 3, "near", "elsewhere", 5, 0.5, None)], "cluster string, side int, kind string, neighbour string, end int, frequency double, distance double")
    got = C.neighbour_rounds(choices, clusters, neighbours, spark.createDataFrame([], "contig long"), (C.Round(1.0, plain=True, final=True),))
    assert sorted((r.place, r.cluster) for r in got.collect()) == [(0, "b"), (1, "a"), (2, "é")]
    assert kinds == [["int", "int", "int"]]


def test_neighbour_rounds_of_nothing(spark, sf_dir):
    choices, *rest = Q.consistency_input(spark, sf_dir)
    assert C.neighbour_rounds(choices.limit(0), *rest).count() == 0


def other(x):
    return (x[0], 8 - x[1])


def plain_bubbles(best):
    """Walks over dictionaries, a bubble at a time; bubbles that share a chain wait for the one with the smallest end."""
    to = {(a, b): (c, d) for a, b, c, d, _ in best}
    weight = {((a, b), (c, d)): w for a, b, c, d, w in best}
    mutual = {x: y for x, y in to.items() if to.get(y) == x and x[0] != y[0]}
    strength = {(x, y): weight[x, y] for x, y in mutual.items()}

    def walk(x):
        """The loose end that a walk out of x comes to, and the weights on the way."""
        seen, weights = set(), []
        while x in mutual:
            if x in seen:
                return None, []
            seen.add(x)
            weights.append(strength[x, mutual[x]])
            x = other(mutual[x])
        return x, weights

    used = set()
    while True:
        found = []
        for x in sorted(set(to) - set(mutual) - used):
            if other(x) not in mutual:
                continue
            alt, second = walk(to[x])
            if alt is None or alt == x or alt not in to:
                continue
            home, first = walk(to[alt])
            if home != x:
                continue
            one, two = [weight[x, to[x]], *first], [weight[alt, to[alt]], *second]
            p = x if min(one) + max(one) >= min(two) + max(two) else alt
            chains = {min(e, walk(other(e))[0] if other(e) in mutual else other(e)) for e in (x, alt)}
            found.append((x, p, to[p], weight[p, to[p]], chains))
        taken, done = {}, []
        for x, *_, chains in found:
            for c in chains:
                taken[c] = min(taken.get(c, x), x)
        for x, p, q, w, chains in found:
            if all(taken[c] == x for c in chains):
                done.append((x, p, q, w))
        if not done:
            return sorted((*x, *y, strength[x, y]) for x, y in mutual.items() if x < y)
        for x, p, q, w in done:
            if q in mutual:
                del mutual[mutual[q]]
            mutual[p], mutual[q] = q, p
            strength[p, q] = strength[q, p] = w
            to[q] = p
            weight[q, p] = w
            used.add(x)


def chain_edges(clusters, weight):
    """Best edges along a chain of clusters that are all read forward: 3 end to 5 end, both ways."""
    return [e for a, b in zip(clusters, clusters[1:], strict=False) for e in ((a, 3, b, 5, weight), (b, 5, a, 3, weight))]


BUBBLE = [*chain_edges([1, 2, 3, 4], 10), *chain_edges([7, 8, 9, 10], 12)]
BUBBLE += [(4, 3, 9, 5, 6), (7, 5, 2, 3, 4)]  # 1-2-[3-4] with [7-8]-9-10


def test_a_bubble_by_hand(spark):
    """Path one (weights 6, 10, 10) beats path two (4, 12): 4 joins 9, and 7-8 is cut off."""
    rows = sorted(map(tuple, B.collapsed(spark.createDataFrame(BUBBLE, "c1 long, e1 int, c2 long, e2 int, weight long")).collect()))
    assert rows == sorted([(1, 3, 2, 5, 10), (2, 3, 3, 5, 10), (3, 3, 4, 5, 10), (4, 3, 9, 5, 6), (7, 3, 8, 5, 12), (9, 3, 10, 5, 12)])
    assert rows == plain_bubbles(BUBBLE)


@pytest.mark.parametrize("seed", range(3))
def test_bubbles(spark, seed):
    """Chains that overlap at their ends, in rows and in circles, and best edges at random."""
    rng = random.Random(seed)
    best, n, chains = {}, 0, []
    for _ in range(12):
        size = rng.randint(1, 7)
        chains.append(list(range(n, n + size)))
        n += size
        for a, e, b, f, w in chain_edges(chains[-1], rng.randint(3, 9)):
            best[a, e] = (b, f, w)
    if seed % 2:
        a, b = chains[-1][0], chains[-1][-1]
        if a != b:
            best[b, 3], best[a, 5] = (a, 5, 4), (b, 3, 4)  # a circle
    for one, two in zip(chains, chains[1:] + chains[:1], strict=True):
        if rng.random() < 0.8 and (one[-1], 3) not in best and (two[0], 5) not in best:
            best[one[-1], 3] = (rng.choice(two), 5, rng.randint(1, 9))
            best[two[0], 5] = (rng.choice(one), 3, rng.randint(1, 9))
    for c in range(n):
        for e in (3, 5):
            if (c, e) not in best and rng.random() < 0.7:
                best[c, e] = (rng.randrange(n), rng.choice((3, 5)), rng.randint(1, 9))
    rows = [(*x, *y) for x, y in best.items()]
    got = sorted(map(tuple, B.collapsed(spark.createDataFrame(rows, "c1 long, e1 int, c2 long, e2 int, weight long")).collect()))
    assert got == plain_bubbles(rows)


def test_reach_of_a_long_chain(spark):
    x = "struct<cluster:long,end:int>"
    rows = [((a, e), (b, f), w) for a, e, b, f, w in chain_edges(list(range(300)), 5)] + [((900, 3), (901, 5), 1), ((901, 5), (900, 3), 1), ((901, 3), (900, 5), 1), ((900, 5), (901, 3), 1)]
    got = {tuple(r.x): (tuple(r.loose), r.steps, r.low) for r in B.reaches(spark.createDataFrame(rows, f"x {x}, y {x}, weight long")).collect()}
    assert got == {(c, 3): ((299, 3), 299 - c, 5 if c < 299 else None) for c in range(300)} | {(c, 5): ((0, 5), c, 5 if c else None) for c in range(300)}


def plain_walks(starts, edges, core, genomes, depth):
    """Depth first, with sets of genomes."""
    has = defaultdict(lambda: defaultdict(set))
    for c1, e1, c2, e2, g in edges:
        has[c1, e1][c2, e2].add(g)
        has[c2, e2][c1, e1].add(g)
    known = set().union(*(gs for to in has.values() for gs in to.values()))
    out = []
    name = lambda x: f"{x[0]}{'+' if x[1] == 3 else '-'}"

    def go(start, stop, at, path, held, steps):
        reason = "stop" if steps > 1 and at[0] == stop else "core" if steps > 1 and at[0] in core else "end" if not has.get(at) else "depth" if steps > depth else None
        if reason:
            out.append((start, ":".join(path), reason, steps, frozenset(held)))
            return
        for b, gs in has[at].items():
            if held & gs:
                go(start, stop, other(b), [*path, name(other(b))], held & gs, steps + 1)
        rest = held - set().union(*has[at].values())
        if rest:
            out.append((start, ":".join(path), "left", steps, frozenset(rest)))

    for start, at, stop in starts:
        go(start, stop, at, [name(at)], known, 1)
    return Counter(out)


def genomes_of(vector, names):
    return frozenset(names[64 * k + b] for k, w in enumerate(vector) for b in range(64) if w >> b & 1)


@pytest.mark.parametrize("depth", [2, 6])
def test_walks(spark, sf_dir, depth):
    starts, edges, genomes, core = Q.walk_input(spark, sf_dir)
    got = K.walks(starts, K.bit_vectors(edges, genomes), core, depth).collect()
    names = {r.number: r.genome for r in genomes.collect()}
    assert all(r.n == len(genomes_of(r.vector, names)) for r in got)
    got = Counter((r.id, r.path, r.reason, r.steps, genomes_of(r.vector, names)) for r in got)
    rows = [(r.id, tuple(r.at), r.stop) for r in starts.collect()]
    assert got == plain_walks(rows, list(map(tuple, edges.collect())), {r.cluster for r in core.collect()}, names, depth)
    assert {"core", "depth", "left"} <= {k[2] for k in got}


def test_walks_of_many_genomes(spark):
    rng = random.Random(3)
    edges = [(c, 3, rng.choice((c + 1, c + 1, c + 2)), 5, g) for g in range(150) for c in range(8) if rng.random() < 0.9]
    starts = [("a", (0, 3), 7), ("b", (2, 3), None), ("c", (50, 5), 1)]
    x = "struct<cluster:long,end:int>"
    genomes = spark.range(150).selectExpr("id as genome", "id as number")
    v = K.bit_vectors(spark.createDataFrame(edges, "c1 long, e1 int, c2 long, e2 int, genome long"), genomes)
    got = K.walks(spark.createDataFrame(starts, f"id string, at {x}, stop long"), v, spark.createDataFrame([(5,)], "cluster long"), 20).collect()
    got = Counter((r.id, r.path, r.reason, r.steps, genomes_of(r.vector, dict(enumerate(range(150))) | {k: k for k in range(150)})) for r in got)
    assert got == plain_walks(starts, edges, {5}, None, 20)
    none = K.walks(spark.createDataFrame(starts, f"id string, at {x}, stop long"), v.limit(0), spark.createDataFrame([(5,)], "cluster long"), 20)
    assert {(r.reason, r.n) for r in none.collect()} == {("end", 0)}


def test_large_settled_tables_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(G, "BROADCAST_ROWS", 10)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    table = lambda n: G.settle(spark.range(n), merge=True)
    big, small = table(50), table(5)
    assert "BroadcastHashJoin" not in plan(big.join(big.select(F.col("id").alias("to")), F.col("id") == F.col("to")))
    assert "BroadcastHashJoin" in plan(small.join(small.withColumnRenamed("id", "to"), F.col("id") == F.col("to")))
    assert "BroadcastHashJoin" in plan(big.join(F.broadcast(small), "id")) and big.join(small, "id").count() == 5
    assert table(0).count() == 0 and G.settle(spark.range(50).limit(0), merge=True).isEmpty()


def test_walks_over_words(spark):
    """Edges as rows of single longs give the walks of whole vectors; an edge of one genome among a million is one row."""
    rng = random.Random(4)
    edges = [(c, 3, rng.choice((c + 1, c + 2)), 5, g) for g in (0, 63, 64, 999_999) for c in range(5) if rng.random() < 0.9]
    e = spark.createDataFrame(edges, "c1 long, e1 int, c2 long, e2 int, genome long")
    w = K.bit_words(e, spark.range(1_000_000).selectExpr("id as genome", "id as number"))
    assert w.count() <= 2 * len(edges) and w.where("bits = 0").isEmpty()
    starts, core = spark.createDataFrame([("a", (0, 3), 4)], "id string, at struct<cluster:long,end:int>, stop long"), spark.createDataFrame([(5,)], "cluster long")
    rows = lambda v: Counter(tuple(r) for r in K.walks(starts, v, core, 6).drop("vector").collect())
    few = {g: n for n, g in enumerate((0, 63, 64, 999_999))}
    assert rows(w) == rows(K.bit_vectors(e, spark.createDataFrame(list(few.items()), "genome long, number long"))) and rows(w)


def plain_linkage(d, method):
    """One merge at a time, nearest first; items that lack a distance are 1 apart, clusters that lack all stay apart."""
    items = {x: frozenset([x]) for p in d for x in p}
    out = []

    def distance(a, b):
        known = [d[min(x, y), max(x, y)] for x in items[a] for y in items[b] if (min(x, y), max(x, y)) in d]
        if not known:
            return None
        n = len(items[a]) * len(items[b])
        if method == "average":
            return (sum(known) + n - len(known)) / n
        return min(known) if method == "single" else max([*known, 1.0] if len(known) < n else known)

    while True:
        able = [(x, a, b) for a in items for b in items if a < b and (x := distance(a, b)) is not None]
        if not able:
            return sorted(out)
        x, a, b = min(able)
        items[a] = items[a] | items.pop(b)
        out.append((a, b, pytest.approx(x / 2), len(items[a])))


@pytest.mark.parametrize("method", ["complete", "average", "single"])
def test_linkage_in_rounds(spark, method):
    rng = random.Random(5)
    d = {(a, b): round(rng.random(), 6) for a in range(24) for b in range(a + 1, 24) if rng.random() < 0.9}
    d |= {(100, 101): 0.3}
    df = spark.createDataFrame([(*(p if rng.random() < 0.5 else p[::-1]), x) for p, x in d.items()], "a long, b long, distance double")
    got = L.linkage(df, method)
    assert sorted((r.low, r.high, r.height, r.size) for r in got.collect()) == plain_linkage(d, method)
    assert got.agg({"round": "max"}).first()[0] < 20
    assert L.linkage(df.limit(0), method).count() == 0


@pytest.mark.parametrize("method", ["complete", "average", "single"])
def test_linkage_folds_few_pairs(spark, method):
    """Two rounds of jobs or so and a fold merge what one merge at a time does; rounds over few pairs are no jobs of their own: 30 rounds here."""
    rng = random.Random(6)
    d = {(a, b): round(rng.random(), 6) for a in range(16) for b in range(a + 1, 16) if rng.random() < 0.8} | {(40, 41): 0.5}
    df = spark.createDataFrame([(*p, x) for p, x in d.items()], "a long, b long, distance double")
    assert sorted((r.low, r.high, r.height, r.size) for r in L.linkage(df, method, fold_pairs=40).collect()) == plain_linkage(d, method)
    line = spark.createDataFrame([(a, b, b / 100) for a in range(31) for b in range(a + 1, 31)], "a long, b long, distance double")
    spark.sparkContext.setJobGroup(f"line-{method}", "")
    assert L.linkage(line, method).agg({"round": "max"}).first()[0] == 30
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"line-{method}")) < 40
    spark.sparkContext.setJobGroup("", "")


def test_linkage_of_sets_by_blocks(spark, monkeypatch):
    """Equal sets, items that share nothing with some or with all others, and clusters over parts of blocks; no table of all pairs is read."""
    rng = random.Random(11)
    sets = {n: frozenset(rng.sample(range(9 * (n % 2), 12 + 9 * (n % 2)), rng.randint(2, 6))) for n in range(60)}
    sets |= {100 + n: sets[n % 7] for n in range(12)} | {200: frozenset([99]), 201: frozenset([98]), 202: frozenset([98])}
    d = {(a, b): round(1 - len(sets[a] & sets[b]) * 100 / len(sets[a] | sets[b]) / 100, 9) for a in sets for b in sets if a < b and sets[a] & sets[b]}
    df = spark.createDataFrame([(f"{n:03}", x if x != 3 else None) for n, s in sets.items() for x in [*s, min(s)]] + [(None, 5)], "item string, x long")
    want = sorted((f"{a:03}", f"{b:03}", h, n) for a, b, h, n in plain_linkage(d, "complete"))
    rows = lambda got: sorted((r.low, r.high, r.height, r.size) for r in got.collect())
    assert rows(L.set_linkage(df)) == want
    monkeypatch.setattr(L, "BLOCK_ITEMS", 20)
    monkeypatch.setattr(L, "PART_ITEMS", (3, 5))
    monkeypatch.setattr(L, "PART_ELEMENTS", 4)
    assert rows(L.set_linkage(df, fold_pairs=100)) == want
    assert L.set_linkage(df.limit(0)).count() == 0


def test_shares_of_blocks_by_parts(monkeypatch):
    import numpy as np

    rng = random.Random(12)
    sets = [[(c, frozenset(rng.sample(range(30), rng.randint(1, 3)))) for c in sorted(rng.choices(range(12), k=40))] for _ in range(2)]
    packed = [(np.array([c for c, _ in s]), np.array([len(x) for _, x in s], "int32"), np.array([e for _, x in s for e in sorted(x)], "int32")) for s in sets]
    every = [[[100 * len(x & y) / len(x | y) for c, x in sets[0] if c == a for e, y in sets[1] if e == b] for b in sorted({c for c, _ in sets[1]})] for a in sorted({c for c, _ in sets[0]})]
    for parts, elements in (((128, 2048), 4096), ((3, 5), 4), ((1, 40), 7)):
        monkeypatch.setattr(L, "PART_ITEMS", parts)
        monkeypatch.setattr(L, "PART_ELEMENTS", elements)
        least, meet = L._shares(*packed)
        assert least.tolist() == [[min(v) for v in row] for row in every] and meet.tolist() == [[max(v) > 0 for v in row] for row in every]


def test_linkage_of_users_has_no_table_of_pairs(spark, sf_dir, monkeypatch):
    from lociweave.plans import rounds as R

    monkeypatch.setattr(R, "user_distances", None)
    assert R.g11_linkage(spark, sf_dir).count() > 0


def same_newick(got, want):
    lengths = [[float(x) for x in re.findall(r":(-?[0-9.]+)", t)] for t in (got, want)]
    assert re.sub(r":-?[0-9.]+", "", got) == re.sub(r":-?[0-9.]+", "", want) and lengths[0] == pytest.approx(lengths[1], abs=2e-6)


@pytest.mark.parametrize("method, text", [("single", "((a:1,b:1):1,c:2);"), ("complete", "((a:1,b:1):2,c:3);"), ("average", "((a:1,b:1):1.5,c:2.5);")])
def test_linkage_newick(spark, method, text):
    d = spark.createDataFrame([("a", "b", 2.0), ("a", "c", 4.0), ("b", "c", 6.0)], "a string, b string, distance double")
    same_newick(L.linkage_newick(d, method, missing=9.0).first().newick, text)


def plain_joining(d, names):
    d, label = {frozenset(p): x for p, x in d.items()}, {n: str(n) for n in names}
    f = lambda x: f":{x:.6f}"
    while len(label) > 3:
        r = {a: sum(d[frozenset((a, b))] for b in label if b != a) / (len(label) - 2) for a in label}
        _, a, b = min((round(d[frozenset((a, b))] - r[a] - r[b], 9), a, b) for a in label for b in label if a < b)
        x = d[frozenset((a, b))]
        one = x / 2 + (r[a] - r[b]) / 2
        for c in label:
            if c not in (a, b):
                d[frozenset((a, c))] = (d[frozenset((a, c))] + d[frozenset((b, c))] - x) / 2
        label[a] = f"({label[a]}{f(one)},{label[b]}{f(x - one)})"
        del label[b]
    total = sum(d[frozenset((a, b))] for a in label for b in label if a < b)
    own = {a: sum(d[frozenset((a, b))] for b in label if b != a) for a in label}
    length = lambda a: own[a] - total / 2 if len(label) == 3 else total / 2
    return "(" + ",".join(label[a] + f(length(a)) for a in sorted(label)) + ");"


@pytest.mark.parametrize("n", [2, 3, 4, 9])
def test_neighbour_joining(spark, n):
    rng = random.Random(n)
    d = {(a, b): round(rng.random() + 0.1, 6) for a in range(n) for b in range(a + 1, n)}
    df = spark.createDataFrame([(a, b, x) for (a, b), x in d.items()], "a long, b long, distance double")
    same_newick(L.neighbour_joining(df).first().newick, plain_joining(d, range(n)))
    assert L.neighbour_joining(df.limit(0)).count() == 0


def test_joining_finds_an_additive_tree(spark):
    """Distances along a tree: its sides and lengths come back."""
    d = {("a", "b"): 5, ("a", "c"): 9, ("a", "d"): 9, ("a", "e"): 8, ("b", "c"): 10, ("b", "d"): 10, ("b", "e"): 9, ("c", "d"): 8, ("c", "e"): 7, ("d", "e"): 3}
    got = L.neighbour_joining(spark.createDataFrame([(*p, float(x)) for p, x in d.items()], "a string, b string, distance double")).first().newick
    assert "a:2.000000,b:3.000000" in got and "d:2.000000" in got and "e:1.000000" in got and "c:4.000000" in got


def plain_representatives(nodes, first, pairs, redundant, quit, stop_mean, stop_least, most, at_once, stop_new=0):
    d = {}
    for a, b, x in pairs:
        for p in ((a, b), (b, a)):
            d[p] = min(x, d.get(p, 2))
    ident = lambda x: round(100 * (1 - x), 9)
    order = [n for n, _ in sorted(first, key=lambda r: r[1])]
    out = [(n, "representative", None, None, 0) for n in order]
    rest = [n for n, _ in sorted(nodes, key=lambda r: r[1]) if n not in order]
    joined, last, n_round = 0, False, 0
    near = {}
    while True:
        n_round += 1
        lost = 0
        for n in list(rest):
            for k in range(joined, len(order)):
                x = d.get((order[k], n), 1.0)
                if ident(x) >= redundant:
                    out.append((n, "redundant", order[k], ident(x), n_round))
                    rest.remove(n)
                    lost += 1
                    break
                if n not in near or x < near[n][0]:
                    near[n] = (x, k)
        joined = len(order)
        if last or not rest:
            return out + [(n, "covered", order[near[n][1]], ident(near[n][0]), n_round) for n in rest]
        ids = [ident(near[n][0]) for n in rest]
        far = {}
        for n in rest:
            x, k = near[n]
            if k not in far or x > far[k][0]:
                far[k] = (x, n)
        picks = sorted((-x, k, n) for k, (x, n) in far.items() if ident(x) < quit)[: max(0, min(most - len(order), len(order), at_once))]
        for x, k, n in picks:
            out.append((n, "representative", order[k], ident(-x), n_round))
            rest.remove(n)
        before = len(rest) + len(picks) + lost
        order += [n for *_, n in picks]
        last = sum(ids) / len(ids) >= stop_mean or min(ids) >= stop_least or len(picks) <= stop_new or len(picks) + lost == before or len(order) >= most


@pytest.mark.parametrize("seed", range(4))
def test_farthest_representatives(spark, seed):
    rng = random.Random(seed)
    n = 40
    nodes = [(k, (k * 7) % n) for k in range(n)]
    at = {k: (rng.random(), rng.random()) for k in range(n)}
    pairs = [(a, b, round(min(1, 0.5 * ((at[a][0] - at[b][0]) ** 2 + (at[a][1] - at[b][1]) ** 2) ** 0.5), 2)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.95]
    first = [(3, 0), (11, 1)][: 1 + seed % 2]
    options = [dict(redundant=97, quit=90, stop_mean=96, stop_least=93, most=30, at_once=4), dict(redundant=101, quit=100.5, stop_mean=101, stop_least=101, most=15, at_once=8), dict(redundant=90, quit=95, stop_mean=101, stop_least=101, most=40, at_once=2), dict(redundant=98, quit=80, stop_mean=99, stop_least=99, most=40, at_once=9)][seed]
    got = D.farthest_representatives(spark.createDataFrame(nodes, "node long, place long"), spark.createDataFrame(first, "node long, number long"), spark.createDataFrame(pairs, "a long, b long, distance double"), **options).collect()
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, got), key=key) == sorted(plain_representatives(nodes, first, pairs, **options), key=key)


def test_representatives_query(spark, sf_dir):
    nodes, first, pairs = Q.representative_input(spark, sf_dir)
    want = plain_representatives(*([tuple(r) for r in t.collect()] for t in (nodes, first, pairs)), **Q.NEAR)
    assert sorted(map(tuple, Q.t08_far(spark, sf_dir).collect())) == sorted(want, key=lambda r: r[0])


def test_fragment_groups_by_both_rules(spark):
    rng = random.Random(11)
    for round_ in range(3):
        contigs = {c: rng.randint(1, 9) for c in range(12)}
        places = [(100 * c + p, c, p + 3, c % 3, rng.randint(1, 30)) for c, n in contigs.items() for p in range(n)]
        feats = [p[0] for p in places]
        hits, seen = [], set()
        for q in range(60):
            for s in rng.sample(feats, rng.randint(1, 4)):
                a = rng.randint(1, 40)
                hits.append((q, s, a, a + rng.randint(3, 20)))
        whole = [(f, rng.randint(0, 3)) for f in feats if rng.random() < 0.5]
        at = {f: (c, p, g, n) for f, c, p, g, n in places}
        links = Counter()
        for q in range(60):
            for g in range(3):
                own = sorted((h for h in hits if h[0] == q and at[h[1]][2] == g), key=lambda h: h[1])
                fits = lambda x, y: x[3] - x[2] + y[3] - y[2] + 2 < 1.33 * (max(x[3], y[3]) - min(x[2], y[2]) + 1)
                near_end = lambda h: at[h[1]][1] - 3 < 2 or contigs[at[h[1]][0]] - 1 - (at[h[1]][1] - 3) < 2
                if len(own) == 2 and all(map(near_end, own)):
                    if fits(*own):
                        links[tuple(sorted(h[1] for h in own))] += 1
                    continue
                for c in contigs:
                    row = sorted((h for h in own if at[h[1]][0] == c), key=lambda h: (at[h[1]][1], h[1]))
                    for x, y in zip(row, row[1:], strict=False):
                        if 1 <= at[y[1]][1] - at[x[1]][1] <= 3 and fits(x, y):
                            links[tuple(sorted((x[1], y[1])))] += 1
        n = dict(whole)
        root = {f: f for f in feats}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        kept = [e for e, w in links.items() if all(2 * w >= n.get(f, 0) for f in e)]
        for a, b in kept:
            a, b = sorted((find(a), find(b)))
            root[b] = a
        groups = defaultdict(list)
        for f in {f for e in kept for f in e}:
            groups[find(f)].append(f)
        want = {(f, r, f == min(fs, key=lambda x: (-at[x][3], x))) for r, fs in groups.items() for f in fs}
        got = P.fragment_groups(
            spark.createDataFrame(hits, "qid long, sid long, start int, stop int"),
            spark.createDataFrame(places, "feat long, contig int, pos int, genome int, length int"),
            spark.createDataFrame(whole, "feat long, n int"),
        )
        assert {(r.feat, r.group, r.kept) for r in got.collect()} == want and want


def plain_neighbours(features, core):
    """features: contig, place, cluster, genome, orient."""
    by = defaultdict(list)
    for r in features:
        by[r[0]].append(r)
    genomes, steps = defaultdict(set), defaultdict(list)
    facing = lambda orient, side: 3 if orient == side else 5
    for rows in by.values():
        rows.sort(key=lambda r: r[1])
        for i, r in enumerate(rows):
            for side in (-1, 1):
                beside = [("near", i + side)]
                j = i + side
                while 0 <= j < len(rows) and rows[j][2] not in core:
                    j += side
                beside.append(("core", j))
                for kind, j in beside:
                    if 0 <= j < len(rows):
                        key = (r[2], facing(r[4], side), kind, rows[j][2], facing(rows[j][4], -side))
                        genomes[key].add(r[3])
                        steps[key].append(abs(j - i))
    ends = defaultdict(list)
    for key, gs in genomes.items():
        ends[key[:3]].append((key, len(gs)))
    out = []
    for (c, s, kind), found in ends.items():
        ranks = sorted({n for _, n in found})
        for key, n in found:
            f = n / sum(m for _, m in found) if kind == "near" else (ranks.index(n) + 1) / len(ranks)
            out.append((*key, f, sum(steps[key]) / len(steps[key]) if kind == "core" else None))
    return out


def test_neighbour_table(spark, sf_dir):
    f = features(spark, sf_dir).select("contig", "pos", "cluster", "genome", "orient")
    core = {r.cluster for r in f.select("cluster").distinct().collect() if len(r.cluster) % 2}
    got = C.neighbour_table(f, spark.createDataFrame([(c,) for c in core], "cluster string"), ["pos"])
    got = got.select("cluster", "side", "kind", "neighbour", "end", "frequency", "distance").collect()
    want = plain_neighbours(list(map(tuple, f.collect())), core)
    order = lambda rows: sorted(map(tuple, rows), key=lambda r: r[:5])
    assert [r[:5] for r in order(got)] == [r[:5] for r in order(want)]
    for g, w in zip(order(got), order(want), strict=True):
        assert g[5:] == pytest.approx(w[5:])


def plain_refined(choices, first, genomes, circular, core_percent, schedule, limit):
    total, clusters = len(set(genomes.values())), {r.cluster for r in choices}
    calls, seen = [(r.contig, r.place, 0, r.part, r.cluster, r.inverted) for r in first], []
    for n in range(1, limit + 1):
        copies = Counter((c[4], genomes[c[0]]) for c in calls)
        held = Counter(c for c, _ in copies)
        core = {c for c in clusters if held[c] * 100 >= total * core_percent and max((k for (x, _), k in copies.items() if x == c), default=0) == 1}
        rows = [(c[0], c[1:4], c[4], genomes[c[0]], -1 if c[5] else 1) for c in calls]
        table = [N(*r) for r in plain_neighbours(rows, core)]
        made, _ = plain_rounds(choices, [I(c, held[c] / total, c in core) for c in clusters], table, circular, schedule)
        calls = [(c, p, s, q, x, inv) for c, p, s, q, x, _, _, inv in made]
        by, edges = defaultdict(list), defaultdict(set)
        for c in calls:
            by[c[0]].append(c)
        for contig, own in by.items():
            own.sort(key=lambda c: c[1:4])
            pairs = list(zip(own, own[1:], strict=False)) + ([(own[-1], own[0])] if contig in circular and len(own) > 1 else [])
            for x, y in pairs:
                a, b = sorted([(x[4], 5 if x[5] else 3), (y[4], 3 if y[5] else 5)])
                edges[*a, *b].add(genomes[contig])
        now = {e: len(gs) for e, gs in edges.items()}
        ended = "stable" if seen and now == seen[-1] else "circle" if now in seen else "limit" if n == limit else None
        if ended:
            return sorted((*e, w, n, ended) for e, w in now.items())
        seen.append(now)
    return None


def test_refined_graph(spark, sf_dir):
    choices, first, genomes, circular = Q.refinement_input(spark, sf_dir)
    few = 3
    some = lambda df: df.where(f"contig < {few}")
    choices, first, genomes, circular = map(some, (choices, first, genomes, circular))
    schedule = (C.Round(0.9), C.Round(1.0, plain=True, final=True))
    for limit, least in ((1, 0), (4, 60)):
        got = C.refined_graph(choices, first, genomes, circular, least, schedule, limit).collect()
        want = plain_refined(choices.collect(), first.collect(), {r.contig: r.genome for r in genomes.collect()}, {r.contig for r in circular.collect()}, least, schedule, limit)
        assert sorted(map(tuple, got)) == want


def plain_hierarchy(parent, name, cap):
    """Level by level: a node is a batch if it has at most cap leaves and its parent has more; the tree then ends there."""
    out, label, level = [], {}, 0
    nodes = set(parent)
    while True:
        level += 1
        leaves = nodes - {parent[n] for n in nodes}
        below = defaultdict(set)
        for leaf in leaves:
            n = leaf
            while n is not None:
                below[n].add(leaf)
                n = parent[n]
        top = {}
        for leaf in leaves:
            n = leaf
            while parent[n] is not None and len(below[parent[n]]) <= cap:
                n = parent[n]
            top[leaf] = n
        number = {t: k for k, t in enumerate(sorted(set(top.values())), 1)}
        for leaf, t in top.items():
            out.append((level, number[t], f"L{level}B{number[t]}", label.get(leaf) or name.get(leaf) or str(leaf), level == 1))
        if len(number) == 1:
            return sorted(out)
        label = {t: f"L{level}B{k}" for t, k in number.items()}
        keep = set()
        for t in number:
            while t is not None:
                keep.add(t)
                t = parent[t]
        nodes = keep


@pytest.mark.parametrize("cap", [4, 1000])
def test_hierarchy(spark, cap):
    rng = random.Random(cap)
    parent = {1: None}
    inner, n = [1], 1
    while len(parent) < 41:  # each node that is cut has two children
        at = inner.pop(rng.randrange(len(inner)))
        for _ in range(2):
            n += 1
            parent[n] = at
            inner.append(n)
    name = {k: f"g{k}" for k in parent if k % 3}
    df = spark.createDataFrame([(k, p, name.get(k), 1.0) for k, p in parent.items()], "node long, parent long, name string, length double")
    assert sorted(map(tuple, H.hierarchy(df, cap).collect())) == plain_hierarchy(parent, name, cap)


def test_a_star_cannot_be_cut(spark):
    df = spark.createDataFrame([(0, None, None, 0.0), *((k, 0, None, 1.0) for k in range(1, 9))], "node long, parent long, name string, length double")
    with pytest.raises(ValueError, match="more than 3 leaves"):
        H.hierarchy(df, 3)


def plain_levels(features, edges, parts, greedy):
    cluster, unit = {n: n for n, _ in features}, {n: str(g) for n, g in features}
    for level in sorted({p[0] for p in parts}):
        into = {part: ref for lv, ref, part in parts if lv == level}
        best = {}
        for a, b, s in edges:
            x, y = sorted((cluster[a], cluster[b]))
            if x != y and into[unit[x]] == into[unit[y]]:
                best[x, y] = max(s, best.get((x, y), -1))
        heads = {cluster[n] for n in cluster}
        of = {h: {h} for h in heads}
        for (a, b), _ in sorted(best.items(), key=lambda e: (-e[1], e[0])):
            if of[a] is not of[b] and not (greedy and {unit[x] for x in of[a]} & {unit[x] for x in of[b]}):
                both = of[a] | of[b]
                for x in both:
                    of[x] = both
        cluster = {n: min(of[c]) for n, c in cluster.items()}
        unit = {h: into[unit[h]] for h in heads}
    return cluster


@pytest.mark.parametrize("greedy", [False, True])
def test_clusters_by_levels(spark, greedy):
    rng = random.Random(9)
    feats = [(k, k % 12) for k in range(90)]
    edges = [(a, b, round(rng.random(), 3)) for a, b in itertools.combinations(range(90), 2) if a % 12 != b % 12 and rng.random() < 0.04]
    parts = [(1, f"L1B{g % 4}", str(g)) for g in range(12)] + [(2, f"L2B{b % 2}", f"L1B{b}") for b in range(4)] + [(3, "L3B1", f"L2B{b}") for b in range(2)]
    got = H.by_levels(
        spark.createDataFrame(feats, "node long, genome int"),
        spark.createDataFrame(edges, "a long, b long, score double"),
        spark.createDataFrame(parts, "level int, ref string, part string"),
        H.merged_greedily if greedy else H.linked,
    ).collect()
    got = {r.node: r.cluster for r in got}
    assert got == plain_levels(feats, edges, parts, greedy)
    if not greedy:
        flat = {r.node: r.component for r in G.components(spark.createDataFrame(edges, "a long, b long, score double")).collect()}
        assert got == {n: flat.get(n, n) for n, _ in feats}


def test_farthest_representatives_without_all_pairs(spark, sf_dir):
    """Distances of the new representatives only give what the table of all pairs gives."""
    nodes, first, distances = Q.representatives_to_ask(spark, sf_dir)
    assert callable(distances)
    few = D.farthest_representatives(nodes, first, distances, **Q.NEAR | {"most": 6})
    whole = D.farthest_representatives(nodes, first, Q.user_distances(spark, sf_dir), **Q.NEAR | {"most": 6})
    assert sorted(map(str, few.collect())) == sorted(map(str, whole.collect()))
