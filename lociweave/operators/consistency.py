"""Calls along contigs that depend on what is called beside them, settled in rounds."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import homology_score
from .graph import settle
from .order import adjacency, edge_weights, numbered


class Round(NamedTuple):
    """Choices that reach this fraction of a column's best score stay; plain: groups only stay as the best one, alone; final: only the best stays."""

    fraction: float
    plain: bool = False
    final: bool = False


#: The rising fractions of the rounds.
ROUNDS = (
    *(Round(f) for f in (0.8, 0.8, 0.85, 0.85, 0.9, 0.9, 0.9)),
    *(Round(f, plain=True) for f in (0.95, 0.99)),
    *(Round(f, plain=True, final=True) for f in (0.99, 1.0, 1.0, 1.0)),
)
#: Columns on either side that count as near, the least score of a call, the threshold of the first round, and the score of a distance that is far off.
REACH, MINIMUM, FIRST_THRESHOLD, FAR_OFF = 3, 3.0, 4.0, 0.01

COLUMN = ["contig", "place", "sub"]
CHOICE = [*COLUMN, "choice"]


def _indexed(state: DataFrame, circular: DataFrame) -> DataFrame:
    """Columns with idx (from 0 along the contig), cores (core columns up to and with this one), and n, m of all and of core columns of the contig.

    Columns are numbered by ranges over all contigs, and a contig's first number is taken off, so a contig of any length spreads over tasks.
    """
    cols = state.groupBy(*COLUMN).agg(F.max("core").cast("long").alias("held"))
    ranged = settle(cols.repartitionByRange(*COLUMN).withColumn("_part", F.spark_partition_id()))
    by_part = Window.orderBy("_part")  # one row a range
    before = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.sum("held").alias("c"))
    before = before.select("_part", (F.sum("n").over(by_part) - F.col("n")).alias("_n"), (F.sum("c").over(by_part) - F.col("c")).alias("_c"))
    own = Window.partitionBy("_part").orderBy(*COLUMN)
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    cols = ranged.withColumns({"_k": F.row_number().over(own), "_h": F.sum("held").over(upto)}).join(F.broadcast(before), "_part")
    cols = cols.select(*COLUMN, "held", (F.col("_k") + F.col("_n")).alias("_k"), (F.col("_h") + F.col("_c")).alias("_h"))
    contigs = cols.groupBy("contig").agg(F.min("_k").alias("_k0"), F.min(F.col("_h") - F.col("held")).alias("_h0"), F.count(F.lit(1)).alias("n"), F.sum("held").alias("m"))
    contigs = contigs.join(circular.select("contig", F.lit(True).alias("circular")), "contig", "left").withColumn("circular", F.coalesce("circular", F.lit(False)))
    return cols.join(contigs, "contig").select(*COLUMN, "held", (F.col("_k") - F.col("_k0")).alias("idx"), (F.col("_h") - F.col("_h0")).alias("cores"), "n", "m", "circular")


def _observed(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """near and core: contig, idx, side (-1 left, 1 right), neighbour, turned, distance of what stands within REACH columns, or core columns, of each column; the nearest of a cluster counts.

    Which is nearest (then not turned, then the distance) is the least of one number, so Spark aggregates by hashing. Rows are dealt by column, as what follows needs them.
    """
    cells = placed.select("contig", "idx", "cluster", "inverted", "core", (F.col("cores") - 1).alias("rank"), "n", "m", "circular")
    cols = placed.select("contig", "idx", "held", "cores", "n", "m", "circular").distinct()
    sides = F.explode(F.array(F.lit(-1), F.lit(1))).alias("side")
    steps = lambda most: F.explode(F.when(most > 0, F.sequence(F.lit(1), F.least(F.lit(REACH).cast("long"), most)))).alias("o")
    near = cells.select("contig", "idx", "cluster", "inverted", "n", "circular", steps(F.col("n"))).select("*", sides).withColumn("at", F.col("idx") - F.col("side") * F.col("o"))
    near = near.where("circular or at between 0 and n - 1").select("contig", F.expr("pmod(at, n)").alias("idx"), "side", "cluster", "inverted", "o", F.col("o").alias("distance"))
    want = cols.select("contig", "idx", "held", "cores", "n", "m", "circular", steps(F.col("m"))).select("*", sides)
    want = want.withColumn("rank", F.when(F.col("side") < 0, F.col("cores") - F.col("held") - F.col("o")).otherwise(F.col("cores") + F.col("o") - 1))
    want = want.where("circular or rank between 0 and m - 1").select("contig", "idx", "side", F.expr("pmod(rank, m)").alias("rank"), "o", "n")
    got = cells.where("core").select("contig", F.col("idx").alias("there"), "cluster", "inverted", "rank")
    away = (F.col("there") - F.col("idx")) * F.col("side")
    core = want.join(got, ["contig", "rank"]).select("contig", "idx", "side", "cluster", "inverted", "o", F.when(away > 0, away).otherwise(away + F.col("n")).alias("distance"))
    turn = F.coalesce(F.col("inverted").cast("long") + 1, F.lit(0).cast("long"))
    code = F.min(F.shiftleft(F.col("o").cast("long"), 59) + F.shiftleft(turn, 57) + F.col("distance")).alias("code")
    turn = F.shiftright("code", 57).bitwiseAND(F.lit(3))
    turned, distance = F.when(turn > 0, turn == 2), F.col("code").bitwiseAND(F.lit((1 << 57) - 1))
    nearest = lambda rows: rows.repartition("contig", "idx").groupBy("contig", "idx", "side", "cluster").agg(code).select("contig", "idx", "side", F.col("cluster").alias("neighbour"), turned.alias("turned"), distance.alias("distance"))
    return nearest(near), nearest(core)


def by_pair(neighbours: DataFrame) -> DataFrame:
    """cluster, kind, neighbour, and of each side and end of these: f53 the frequency on side 5 at end 3, d53 its distance; null where there is none."""
    pick = lambda c, s, e: F.max(F.when((F.col("side") == s) & (F.col("end") == e), F.col(c))).alias(f"{c[0]}{s}{e}")
    return neighbours.groupBy("cluster", "kind", "neighbour").agg(*(pick(c, s, e) for c in ("frequency", "distance") for s in (5, 3) for e in (5, 3)))


def _spoken(parts: DataFrame, seen: DataFrame, mates: DataFrame, pairs: DataFrame, kind: str) -> DataFrame:
    """CHOICE, part, and what the best neighbour of a kind says for it on the left and the right: own0, own1 and, at half value, other0, other1.

    Expressions are built up in steps, each value once, so that the generated code stays small enough to be compiled.
    """
    met = parts.join(seen, ["contig", "idx"]).withColumn("own", F.lit(False)).select(*mates.columns).unionByName(mates)
    met = met.join(pairs.where(F.col("kind") == kind).drop("kind"), ["cluster", "neighbour"])
    left = F.col("side") < 0
    ways, core = ("a", "b"), kind == "core"  # ahead of the part, or behind it
    met = met.withColumns({"half": F.col("turned") != left, "five": F.coalesce(F.col("inverted") != left, F.lit(False))})
    pick = lambda c, w, e: F.when(F.col("five") if w == "a" else ~F.col("five"), F.col(f"{c}5{e}")).otherwise(F.col(f"{c}3{e}"))
    base = [*CHOICE, "part", "side"]
    met = met.select(*base, "own", "half", "distance", *(pick(c, w, e).alias(f"{c}{w}{e}") for c in ("fd" if core else "f") for w in ways for e in (5, 3)))
    value = lambda w, e: F.when(F.col("half") if e == 5 else ~F.col("half"), F.col(f"f{w}{e}") / 2).otherwise(F.col(f"f{w}{e}"))
    met = met.withColumns({f"v{w}{e}": value(w, e) for w in ways for e in (5, 3)})
    if core:
        off = lambda w, e: F.abs(F.col(f"d{w}{e}") - F.col("distance")) / F.col(f"d{w}{e}")
        met = met.withColumns({f"o{w}{e}": off(w, e) for w in ways for e in (5, 3)})
        met = met.withColumns({f"d{w}{e}": F.when(F.col(f"o{w}{e}") > 0.99, FAR_OFF).otherwise(1 - F.col(f"o{w}{e}")) for w in ways for e in (5, 3)})
        met = met.withColumns({f"t{w}{e}": F.col(f"v{w}{e}") + F.col(f"d{w}{e}") for w in ways for e in (5, 3)})
        first = F.col("tb5").isNotNull() & (F.col("tb3").isNull() | (F.col("tb5") > F.col("tb3")) | ((F.col("tb5") == F.col("tb3")) & (F.col("db5") >= F.col("db3"))))
        met = met.withColumn("first", first)
        of = lambda c: F.when(F.col("first"), F.col(f"{c}b5")).otherwise(F.col(f"{c}b3"))
        met = met.select(*base, "own", F.greatest("ta5", "ta3").alias("ahead"), *(of(c).alias(c) for c in "tdv"))
        back = F.struct("t", "d", "v")
        met = met.select(*base, "ahead", F.when(~F.col("own") & F.col("t").isNotNull(), back).alias("back"))
    else:
        met = met.select(*base, F.greatest("va5", "va3").alias("ahead"), F.when(~F.col("own"), F.greatest("vb5", "vb3")).alias("back"))
    on = lambda s, c: F.max(F.when(F.col("side") == s, F.col(c)))
    by = met.groupBy(*CHOICE, "part").agg(*(on(s, c).alias(f"{n}{k}") for k, s in enumerate((-1, 1)) for n, c in (("own", "ahead"), ("other", "back"))))
    halved = lambda c: F.col(f"{c}.v") / 2 + F.col(f"{c}.d") if core else F.col(c) / 2
    return by.select(*CHOICE, "part", "own0", "own1", halved("other0").alias("other0"), halved("other1").alias("other1"))


def scored(state: DataFrame, hits: DataFrame, pairs: DataFrame, circular: DataFrame) -> DataFrame:
    """The state's rows with context (what neighbours say for them) and total (with the score of the hit itself). pairs: neighbours by_pair.

    On either side the best near neighbour counts with its frequency, and the best core neighbour with frequency and how well the
    distance fits. One that stands the other way round counts half; the cluster's other side may take its
    place at half value. Parts of a group are near each other too.
    """
    placed = settle(state.join(_indexed(state, circular), COLUMN))
    parts = placed.select(*CHOICE, "part", "cluster", "inverted", "idx")
    grouped = state.join(state.groupBy(*CHOICE).agg(F.count(F.lit(1)).alias("k")).where("k > 1"), CHOICE, "left_semi")
    mates = grouped.groupBy(*CHOICE, F.col("cluster").alias("neighbour")).agg(F.max(F.struct("part", "inverted")).alias("x")).select(*CHOICE, "neighbour", F.col("x.inverted").alias("turned"))
    sides = F.explode(F.array(F.lit(-1), F.lit(1))).alias("side")
    mates = parts.drop("idx").join(mates, CHOICE).select(*CHOICE, "part", "cluster", "inverted", "neighbour", "turned", sides, F.lit(1).cast("long").alias("distance"), F.lit(True).alias("own"))
    rated = state
    for kind, seen in zip(("near", "core"), _observed(placed), strict=True):
        said = _spoken(parts, seen, mates, pairs, kind)
        for k in (0, 1):
            said = said.withColumn(f"{kind}{k}", F.greatest(F.coalesce(f"own{k}", F.lit(0.0)), f"other{k}"))
        rated = rated.join(said.select(*CHOICE, "part", f"{kind}0", f"{kind}1"), [*CHOICE, "part"], "left")
    side = lambda c: F.coalesce(c, F.lit(0.0))
    rated = rated.join(hits, "cluster").withColumn("context", F.round(side("near0") + side("core0") + side("near1") + side("core1"), 9))
    total = F.round(F.col("context") + homology_score(F.col("pid"), F.col("share"), F.col("prevalence"), F.col("hits"), F.col("core")), 9)
    return rated.withColumn("total", total).select(*state.columns, "context", "total")


def _ranked(rows: DataFrame, median: float) -> DataFrame:
    """One row a choice: score and values of its best part, parts, and its rank in the column: score, then sum over the median, then number."""
    best = F.max(F.struct("total", (-F.col("part")).alias("p"), "core", "context", "pid")).alias("b")
    by = rows.groupBy(*CHOICE).agg(best, F.sum(F.col("total") - median).alias("over"), F.count(F.lit(1)).alias("parts"))
    order = Window.partitionBy(*COLUMN).orderBy(F.col("b.total").desc(), F.round("over", 9).desc(), "choice")
    return by.select(*CHOICE, "parts", F.col("b.total").alias("score"), F.col("b.core").alias("core_best"), "b.context", "b.pid", F.row_number().over(order).alias("rank"))


def _thresholds(ranked: DataFrame) -> tuple[float, float]:
    """The median of the best scores outside the core, and the middle between their first quartile and the median of the second best scores."""

    def at(rows: DataFrame, *shares: int) -> list[float]:
        k = numbered(rows.select("score", *CHOICE), "score", *CHOICE)
        n = k.count()
        got = {r["k"]: r["score"] for r in k.where(F.col("k").isin([n // s + 1 for s in shares])).select("k", "score").collect()}
        return [got.get(n // s + 1, 0.0) for s in shares]

    outside = ranked.where("rank = 1 and not core_best").select(*COLUMN)
    median, quarter = at(ranked.where("rank = 1 and not core_best"), 2, 4)
    (second,) = at(ranked.where("rank = 2").join(outside, COLUMN, "left_semi"), 2)
    return median, (quarter + second) / 2


def _picked(rows: DataFrame, r: Round, median: float, threshold: float, minimum: float) -> DataFrame:
    """The rows of choices that stay, with score and status: 1 for a call, 0 for an open column, -1 for one that goes."""
    ranked = _ranked(rows, median)
    first = lambda c: F.first(c).over(Window.partitionBy(*COLUMN).orderBy("rank"))
    ranked = ranked.withColumns({"top": first("score"), "top_parts": first("parts"), "top_core": first("core_best"), "top_context": first("context"), "top_pid": first("pid")})
    stays = F.col("rank") == 1
    if not r.final:
        also = F.col("score") >= r.fraction * F.col("top")
        if r.plain:
            also &= (F.col("parts") == 1) & (F.col("top_parts") == 1)
        stays |= also
    sure = F.col("top_core") | (F.col("top") > minimum + 1) | ((F.col("top_context") >= 1) & (F.col("top_pid") >= 90))
    weak = F.when(sure, 1).otherwise(0) if r.final else F.lit(0)
    status = F.when(F.col("top") > threshold, 1).when(F.col("top") > minimum, weak).otherwise(-1)
    return rows.join(ranked.where(stays).select(*CHOICE, "score", "parts", status.alias("status")), CHOICE)


def _state_of(picked: DataFrame, columns: list[str]) -> DataFrame:
    """Columns that went are left out; the parts of a group that is left alone become columns."""
    left = picked.where("status >= 0").withColumn("choices", F.size(F.collect_set("choice").over(Window.partitionBy(*COLUMN))))
    flat = (F.col("choices") == 1) & (F.col("parts") > 1)
    new = {"sub": F.when(flat, F.col("part")).otherwise(F.col("sub")), "part": F.when(flat, 0).otherwise(F.col("part"))}
    return left.withColumns(new).select(columns)


def neighbour_rounds(choices: DataFrame, clusters: DataFrame, neighbours: DataFrame, circular: DataFrame, schedule: tuple[Round, ...] = ROUNDS, minimum: float = MINIMUM) -> DataFrame:
    """contig, place, sub, part, cluster, inverted, score, status: what is called in each column after the rounds; sub and part tell parts of a group apart.

    choices: contig, place, choice, part, cluster, inverted, pid, share, all hits that a column (contig, place) may be; a choice of several parts is a
    group, several clusters side by side. clusters: cluster, prevalence, core. neighbours: cluster, side (5 or 3), kind (near, core), neighbour, end,
    frequency, distance (of core). circular: contig. Each round scores every choice by what may stand beside it,
    keeps the best ones and drops columns below the minimum. A contig is scored again only if its own choices, or the number
    of hits of a cluster that it holds, changed in the round before; scores of the others stay. Rounds up to the last are
    skipped once nothing changes and every column has one choice. State and scores are written each round. Within the rounds clusters are
    numbers of four bytes, so a pair of clusters is one key of eight.
    """
    names = settle(numbered(clusters.select("cluster").distinct(), "cluster").select("cluster", F.col("k").cast("int").alias("code")), merge=True)
    state = choices.select("contig", "place", F.lit(0).alias("sub"), "choice", F.col("part").cast("int").alias("part"), "cluster", "inverted", "pid", "share")
    known = clusters.select("cluster", "prevalence", "core").join(names, "cluster")
    state = settle(state.join(known, "cluster").select(*CHOICE, "part", F.col("code").alias("cluster"), "inverted", "pid", "share", "prevalence", "core"))
    code = lambda df, c: df.join(names.withColumnRenamed("cluster", c), c).drop(c).withColumnRenamed("code", c)
    neighbours = code(code(neighbours, "cluster"), "neighbour")
    columns, pairs = state.columns, settle(by_pair(neighbours))
    count = lambda s: s.groupBy("cluster").agg(F.count(F.lit(1)).alias("hits"))
    sign = lambda s, n: s.groupBy("contig").agg(F.count(F.lit(1)).alias(f"n{n}"), F.bit_xor(F.xxhash64(*CHOICE, "part")).alias(f"h{n}"))
    rows, again, median, threshold, n = None, None, 0.0, FIRST_THRESHOLD, 0
    while True:
        r, hits = schedule[n], count(state)
        if rows is None:
            rows = settle(scored(state, hits, pairs, circular))
            picked = _picked(rows, r, median, threshold, minimum)
            median, threshold = _thresholds(_ranked(rows, median))
        else:
            if again is None or not again.isEmpty():
                old = rows if again is None else rows.join(again, "contig", "left_anti")
                todo = state if again is None else state.join(again, "contig", "left_semi")
                new = scored(todo, hits, pairs, circular)
                rows = settle(new if again is None else old.unionByName(new))
            picked = _picked(rows, r, median, threshold, minimum)
        if n == len(schedule) - 1:
            called = picked.where("status >= 0").withColumnRenamed("cluster", "code").join(names, "code")
            return called.select(*COLUMN, "part", "cluster", "inverted", "score", "status")
        after = settle(_state_of(picked, columns))
        changed = sign(state, 0).join(sign(after, 1), "contig", "full").where("not (n0 <=> n1 and h0 <=> h1)").select("contig")
        moved = hits.join(count(after).withColumnRenamed("hits", "now"), "cluster", "full").where("not (hits <=> now)").select("cluster")
        again = settle(changed.union(after.join(moved, "cluster", "left_semi").select("contig")).distinct())
        state, n = after, n + 1
        if again.isEmpty() and state.groupBy(*COLUMN).agg(F.min("choice").alias("a"), F.max("choice").alias("b")).where("a <> b").isEmpty():
            n = len(schedule) - 1


def neighbour_table(features: DataFrame, core: DataFrame, order: list[str]) -> DataFrame:
    """cluster, side, kind, neighbour, end, frequency, distance: what known genomes have beside each end of a cluster.

    features: contig, cluster, genome, orient and the order's columns; core: cluster. Near: the share of the genomes that have the neighbour.
    Core: the nearest core cluster; the rank of its number of genomes among those of the end, from the least, over how many ranks there
    are; distance is the mean number of steps.
    """
    f = features.join(core.select("cluster", F.lit(True).alias("_core")), "cluster", "left")
    w = Window.partitionBy("contig").orderBy(*order)
    f = f.withColumn("_at", F.row_number().over(w))
    it = F.struct("cluster", "orient", F.col("_at").alias("at"))
    only = F.when(F.col("_core"), it)
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    views = [("near", -1, F.lag(it).over(w)), ("near", 1, F.lead(it).over(w)), ("core", -1, F.last(only, True).over(before)), ("core", 1, F.first(only, True).over(after))]
    f = f.withColumns({f"_v{n}": v for n, (_, _, v) in enumerate(views)})
    beside = F.explode(F.array(*(F.struct(F.lit(kind).alias("kind"), F.lit(side).alias("side"), F.col(f"_v{n}").alias("it")) for n, (kind, side, _) in enumerate(views)))).alias("x")
    rows = f.select("cluster", "genome", "orient", "_at", beside).where("x.it is not null")
    facing = lambda orient, side: F.when(orient == side, 3).otherwise(5)
    rows = rows.select("cluster", "genome", facing(F.col("orient"), F.col("x.side")).alias("side"), "x.kind", F.col("x.it.cluster").alias("neighbour"), facing(F.col("x.it.orient"), -F.col("x.side")).alias("end"), F.abs(F.col("x.it.at") - F.col("_at")).alias("steps"))
    key = ["cluster", "side", "kind"]
    n = rows.groupBy(*key, "neighbour", "end").agg(F.countDistinct("genome").alias("n"), F.avg("steps").alias("steps"))
    rank, all_ = F.dense_rank().over(Window.partitionBy(*key).orderBy("n")), Window.partitionBy(*key)
    n = n.withColumn("_r", rank).withColumn("_most", F.max("_r").over(all_)).withColumn("_sum", F.sum("n").over(all_))
    near = F.col("kind") == "near"
    return n.select(*key, "neighbour", "end", F.when(near, F.col("n") / F.col("_sum")).otherwise(F.col("_r") / F.col("_most")).alias("frequency"), F.when(~near, F.col("steps")).alias("distance"))


def refined_graph(choices: DataFrame, first: DataFrame, genomes: DataFrame, circular: DataFrame, core_percent: float, schedule: tuple[Round, ...] = ROUNDS, max_iterations: int = 20) -> DataFrame:
    """c1, e1, c2, e2, weight, iteration, ended: the graph of clusters that comes out when calls and graph are derived from each other in turn.

    choices: as neighbour_rounds takes them; first: contig, place, sub, part, cluster, inverted, the calls to begin with; genomes: contig, genome. An iteration
    takes sizes, core (in core_percent of the genomes, never twice in one) and neighbours from the calls, calls all columns anew by the rounds, and takes the edges
    from these calls. ended: `stable` if the edges are those of the iteration before, `circle` if they are those of an earlier one (then it would go round
    for ever), `limit` after max_iterations. Edges are known by their number and a hash over them, so all earlier ones are compared without being read.
    """
    total = genomes.select("genome").distinct().count()
    all_clusters = settle(choices.select("cluster").distinct())
    calls, seen, n = settle(first.select(*COLUMN, "part", "cluster", "inverted").join(genomes, "contig")), [], 0
    while True:
        n += 1
        per = calls.groupBy("cluster", "genome").agg(F.count(F.lit(1)).alias("copies")).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max("copies").alias("most"))
        clusters = all_clusters.join(per, "cluster", "left")
        core = F.coalesce((F.col("n") * 100 >= total * core_percent) & (F.col("most") == 1), F.lit(False))
        clusters = settle(clusters.select("cluster", (F.coalesce("n", F.lit(0)) / total).alias("prevalence"), core.alias("core")))
        features = calls.withColumn("orient", F.when(F.col("inverted"), -1).otherwise(1))
        neighbours = settle(neighbour_table(features, clusters.where("core"), ["place", "sub", "part"]))
        calls = settle(neighbour_rounds(choices, clusters, neighbours, circular, schedule).select(*COLUMN, "part", "cluster", "inverted").join(genomes, "contig"))
        features = calls.withColumn("orient", F.when(F.col("inverted"), -1).otherwise(1)).join(circular.select("contig", F.lit(True).alias("ring")), "contig", "left")
        edges = settle(edge_weights(adjacency(features, F.coalesce("ring", F.lit(False)), ["place", "sub", "part"])))
        now = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*edges.columns)), F.sum(F.xxhash64(*reversed(edges.columns)).cast("decimal(38,0)"))).first())
        ended = "stable" if seen and now == seen[-1] else "circle" if now in seen else "limit" if n == max_iterations else None
        if ended:
            return edges.select("*", F.lit(n).alias("iteration"), F.lit(ended).alias("ended"))
        seen.append(now)
