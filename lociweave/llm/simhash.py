"""Operator 6: SimHash near-duplicates by bit-sliced comparison.

1. Arrow functions make a fingerprint of each whole text: a bit is set when more
   than half of the shingles' hashes have it.
2. Equal fingerprints become one row. Each gives block keys so that rows which
   are near share a key:
   for a small radius r over 64 bits, every choice of PARTS - r of PARTS equal
   parts (two fingerprints at most r bits apart agree in one such choice: nothing
   is lost); for wide fingerprints, bands of minimum hashes of the same shingles.
3. Rows are dealt and sorted by key. Blocks of whole groups are compared at once:
   bit planes stand vertically, so one machine word holds a bit of 64 rows, and
   carry-save counters add the differing planes for all pairs. After every few planes the
   rows whose every distance has passed the radius are abandoned. Large groups, beyond a share of all
   rows and HOT at most, are split: each pair of chunks of it is a group of its own.
   A block returns a spanning forest of its links, never all pairs; for wide fingerprints FORESTS disjoint
   spanning forests of its nearest pairs, whose similarity is then computed from the documents' whole sets
   of shingle hashes, so that only pairs that reach it link. Then all other near pairs whose ends that leaves
   apart are looked at in the same way, so none is dropped.
4. Components of the forests' edges join the links. Fingerprints that many rows share
   are broadcast to them, the others joined by shuffle.

Input cases: a null text counts as empty; empty texts have fingerprint zero and
link like any other; repeated rows share a fingerprint; very long texts are hashed
in slices; rows with null doc_id link and pass links on like any other, and a component
without any doc_id is null; empty table: empty result; other columns are ignored by near_components
and kept by keep_first.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, drop_stored, join_counted, join_salted, stored, table, tidy

PARTS = 4
BLOCK = 1024
HOT = 16_384
SHARE = 256  # a chunk of a group holds one in so many rows, but BLOCK / 4 at least and HOT at most
FORESTS = 2
REST = 20_000  # pairs beyond the forests that a pass verifies, at least; as many as rows otherwise
WIDE_WORDS = 16  # 1024 bits
BANDS, BAND_ROWS = 10, 3
_MIX = np.array([xxhash.xxh64_intdigest(f"mix {k}") | 1 for k in range(64)], np.uint64)
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each shingle of lower-cased words, repeats included; of the whole sequence if there are fewer words."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    joined = b" ".join(w)
    n = len(w) - words + 1
    if n < 2:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
    starts = [0, *ends[: n - 1].tolist()]
    stops = (ends[words - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)), np.uint64, n)


def majority(hashes: np.ndarray) -> np.ndarray:
    """Words of the bits that more than half of the rows of (n, k) hashes have; zero without rows."""
    n, k = hashes.shape
    counts = np.zeros(64 * k, np.int64)
    for at in range(0, n, 4096):
        part = np.ascontiguousarray(hashes[at : at + 4096])
        counts += np.unpackbits(part.view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little").sum(0, dtype=np.uint32)
    return np.packbits((counts * 2 > n).astype(np.uint8), bitorder="little").view(np.uint64)


def widened(hashes: np.ndarray, words: int) -> np.ndarray:
    """(n, words) well-mixed words of each hash."""
    x = hashes[:, None] * _MIX[None, :words]
    x ^= x >> np.uint64(29)
    x *= _MIX[None, 16 : 16 + words]
    return x ^ (x >> np.uint64(32))


def band_keys(hashes: np.ndarray) -> list[int]:
    """A key for each band of minimum hashes of distinct hashes."""
    if not len(hashes):
        return [0]
    low = np.array([(x ^ (x >> np.uint64(31))).min() for x in (hashes * m for m in _MIX[32 : 32 + BANDS * BAND_ROWS])], np.uint64)
    return [xxhash.xxh64_intdigest(low[b * BAND_ROWS : (b + 1) * BAND_ROWS].tobytes(), b) - (1 << 63) for b in range(BANDS)]


def fingerprints(docs: DataFrame, words: int, wide: bool = False) -> DataFrame:
    """doc_id, fp (binary, little-endian words) and its number `bits`, or for wide ones `bands`, of each row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[str, tuple] = {}
            rows = []
            for text in b.column(1).to_pylist():
                text = text or ""
                got = seen.get(text)
                if got is None:
                    h = shingle_hashes(text, words)
                    if wide:
                        h = np.unique(h)
                        got = (majority(widened(h, WIDE_WORDS)).tobytes(), band_keys(h))
                    else:
                        bits = majority(h[:, None])
                        got = (bits.tobytes(), int(bits.view(np.int64)[0]))
                    seen[text] = got
                rows.append(got)
            more = pa.array([r[1] for r in rows], pa.list_(pa.int64()) if wide else pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r[0] for r in rows], pa.binary()), more], ["doc_id", "fp", "more"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = docs.select("doc_id", "text").mapInArrow(tidy(make), f"doc_id {kind}, fp binary, more " + ("array<long>" if wide else "long"))
    return made.withColumnRenamed("more", "bands" if wide else "bits")


def planes(fps: np.ndarray) -> np.ndarray:
    """(64 k, ceil(n / 64)) words: bit j of word w of plane b is bit b of row 64 w + j."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(len(fps), -1), axis=1, bitorder="little").T
    pad = -len(fps) % 64
    return np.packbits(np.ascontiguousarray(np.pad(bits, ((0, 0), (0, pad)))), axis=1, bitorder="little").view(np.uint64)


def near_pairs(a: np.ndarray, b: np.ndarray | None, radius: int, step: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of rows of a and b (None: a itself, i < j) at most radius bits apart; (n, k) fingerprints."""
    other = a if b is None else b
    slices = planes(other)
    n, m = len(a), len(other)
    past = np.zeros((n, slices.shape[1] * 64), np.uint8)  # pairs that don't count, or no longer
    past[:, m:] = 1
    if b is None:
        past[:, :m] = np.tri(n, m, dtype=np.uint8)
    past = np.packbits(past, axis=1, bitorder="little").view(np.uint64)
    own = np.unpackbits(a.view(np.uint8).reshape(n, -1), axis=1, bitorder="little").astype(bool)
    rows = np.arange(n)
    width = max(1, radius.bit_length())
    count = [np.zeros_like(past) for _ in range(width)]

    def exceeded() -> np.ndarray:
        more, same = past.copy(), np.full_like(past, FULL)
        for bit in range(width - 1, -1, -1):
            if radius >> bit & 1:
                same &= count[bit]
            else:
                more |= same & count[bit]
                same &= ~count[bit]
        return more

    for at in range(0, len(slices), 2):
        d, e = (slices[at + x][None, :] ^ np.where(own[rows, at + x], FULL, np.uint64(0))[:, None] for x in (0, 1))
        half = d ^ e
        carry = (d & e) | (half & count[0])
        count[0] ^= half
        for bit in range(1, width):
            count[bit], carry = count[bit] ^ carry, count[bit] & carry
        past |= carry
        if at % step == step - 2:
            past = exceeded()
            alive = (past != FULL).any(1)
            if not alive.any():
                return rows[:0], rows[:0]
            if alive.mean() < 0.7:
                rows, past, count = rows[alive], past[alive], [c[alive] for c in count]
    past = exceeded()
    i, j = np.nonzero(np.unpackbits((~past).view(np.uint8), axis=1, bitorder="little"))
    return rows[i], j


def lowest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For n nodes with links (i, j), the smallest node of each one's component."""
    label = np.arange(n)
    while len(i):
        m = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def nearest_forests(n: int, i: np.ndarray, j: np.ndarray, d: np.ndarray, times: int = FORESTS) -> np.ndarray:
    """Places of the pairs (i, j) that form, one after the other, `times` disjoint spanning forests of the least distances d."""
    left = np.argsort(d, kind="stable")
    out = [left[:0]]
    for _ in range(times):
        label, at, took = np.arange(n), np.arange(len(left)), np.zeros(len(left), bool)
        a, b = i[left], j[left]
        while True:
            la, lb = label[a[at]], label[b[at]]
            apart = la != lb
            at, la, lb = at[apart], la[apart], lb[apart]
            if not len(at):
                break
            best = np.full(n, len(left))  # of each tree, its first pair that leaves it
            np.minimum.at(best, la, at)
            np.minimum.at(best, lb, at)
            best = np.unique(best[best < len(left)])
            took[best] = True
            label = lowest(n, label[a[best]], label[b[best]])[label]
        out.append(left[took])
        left = left[~took]
    return np.concatenate(out)


def bits_apart(fps: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Differing bits of each pair of rows of fps, some pairs at a time."""
    parts = [np.bitwise_count(fps[i[k : k + 65_536]] ^ fps[j[k : k + 65_536]]).sum(1, dtype=np.int32) for k in range(0, len(i), 65_536)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def block_links(rows: DataFrame, radius: int, total: int, pairs: bool = False, prints: DataFrame | None = None) -> DataFrame:
    """Edges (a, b) of spanning forests of the links within groups of (key, node, fp), `total` nodes; pairs: edges are the nearest pairs themselves; rows with `label`: all near pairs of different labels.

    prints: rows hold key, node, mark, and prints fp (and label) of each node and mark. Keys of one row, most of them, then go before the wide columns come.
    """
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(sizes, "key")
    if prints is not None:
        rows = rows.join(prints, ["node", "mark"]).drop("mark")
    rest = "label" in rows.columns
    chunks = F.ceil(F.col("n") / min(HOT, max(BLOCK // 4, total // SHARE))).cast("int")
    rows = rows.withColumn("chunks", chunks).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    rows = rows.withColumn("other", other).withColumn("one", F.least("own", "other")).withColumn("two", F.greatest("own", "other"))
    rows = rows.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two", "fp", "node")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def apart(node: np.ndarray, fps: np.ndarray, label: np.ndarray) -> Iterator[pa.RecordBatch]:
            for x in range(0, len(fps), BLOCK):
                for y in range(x, len(fps), BLOCK):
                    one, two = label[x : x + BLOCK], label[y : y + BLOCK]
                    if (one == two[0]).all() and (two == two[0]).all():
                        continue
                    i, j = near_pairs(fps[x : x + BLOCK], None if x == y else fps[y : y + BLOCK], radius)
                    some = one[i] != two[j]
                    if some.any():
                        yield pa.RecordBatch.from_arrays([pa.array(node[i[some] + x]), pa.array(node[j[some] + y])], ["a", "b"])

        def edges(node: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            out_i, out_j = [], []
            for x in range(0, len(fps), BLOCK):
                for y in range(x, len(fps), BLOCK):
                    i, j = near_pairs(fps[x : x + BLOCK], None if x == y else fps[y : y + BLOCK], radius)
                    if pairs:
                        i, j = i + x, j + y
                        i, j = i[node[i] != node[j]], j[node[i] != node[j]]
                        some = nearest_forests(len(fps), i, j, bits_apart(fps, i, j))
                        out_i.append(i[some])
                        out_j.append(j[some])
                        continue
                    label = lowest(2 * BLOCK, i, j + (BLOCK if x != y else 0))
                    tied = np.nonzero(label != np.arange(len(label)))[0]
                    place = lambda k, x=x, y=y: np.where(k < BLOCK, x + k, y + k - BLOCK)
                    out_i.append(place(tied))
                    out_j.append(place(label[tied]))
            if pairs:
                i, j = np.concatenate(out_i), np.concatenate(out_j)
                some = nearest_forests(len(fps), i, j, bits_apart(fps, i, j))
                return pa.RecordBatch.from_arrays([pa.array(node[i[some]]), pa.array(node[j[some]])], ["a", "b"])
            label = lowest(len(fps), np.concatenate(out_i), np.concatenate(out_j))
            tied = np.nonzero(label != np.arange(len(label)))[0]
            return pa.RecordBatch.from_arrays([pa.array(node[tied]), pa.array(node[label[tied]])], ["a", "b"])

        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            """Compare all whole groups held; keep the rows of the last group, which may go on."""
            nonlocal held, count
            group, node, fps, *label = (np.concatenate(c) for c in zip(*held, strict=True))
            linked = lambda a, b: apart(node[a:b], fps[a:b], label[0][a:b]) if rest else iter((edges(node[a:b], fps[a:b]),))
            change = np.nonzero((group[1:] != group[:-1]).any(1))[0] + 1
            ends = [*change.tolist(), *([len(group)] if last else [])]
            start = at = 0
            for end in ends:
                if end - start > BLOCK and at > start:
                    yield from linked(start, at)
                    start = at
                at = end
            if at > start:
                yield from linked(start, at)
            held, count = ([] if at == len(group) else [(group[at:], node[at:], fps[at:], *(c[at:] for c in label))]), len(group) - at

        for b in batches:
            if not b.num_rows:
                continue
            group = np.stack([np.asarray(b.column(c)).astype(np.int64) for c in (0, 1, 2)], 1)
            fps = np.frombuffer(b"".join(b.column(4).to_pylist()), np.uint64).reshape(b.num_rows, -1)
            held.append((group, np.asarray(b.column(3)), fps, *(np.asarray(b.column(c)) for c in range(5, b.num_columns))))
            count += b.num_rows
            if count >= 4 * BLOCK:
                yield from cut(False)
        if held:
            yield from cut(True)

    return rows.select("key", "one", "two", "node", "fp", *(["label"] if rest else [])).mapInArrow(tidy(links), "a long, b long")


def part_keys(radius: int) -> Column:
    """Column: a key for each choice of PARTS - radius of the PARTS parts of a 64-bit `bits`."""
    size = 64 // PARTS
    picks = list(itertools.combinations(range(PARTS), max(1, PARTS - radius)))
    keys = []
    for pick in picks:
        mask = sum(((1 << size) - 1) << (size * p) for p in pick)
        mask -= (mask >> 63) << 64
        keys.append(F.xxhash64(F.col("bits").bitwiseAND(F.lit(mask)), F.lit(mask)))
    return F.array(*keys)


def similar_pairs(pairs: DataFrame, docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of doc_ids whose texts' sets of shingle hashes reach the Jaccard similarity."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                sets = [np.unique(shingle_hashes(t, words)).view(np.int64) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "hashes"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")
    sets = stored(texts.mapInArrow(tidy(hashes), "doc_id long, hashes array<long>").distinct())
    one = join_salted(pairs, sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("ha")), "a").select("a", "b", "ha")
    both = join_salted(one, sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("hb")), "b")
    shared = F.size(F.array_intersect("ha", "hb"))
    return both.where(shared >= similarity * (F.size("ha") + F.size("hb") - shared) - 1e-9).select("a", "b").distinct()


def rest_links(rows: DataFrame, prints: DataFrame, edges: DataFrame, found: DataFrame, radius: int, total: int, verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The stored edges and what they need besides to link all that any near pair links: pairs (a, b) beyond the `found` ones whose ends the edges leave apart.

    A pass verifies about as many pairs as there are rows; later passes leave out what earlier ones linked.
    """
    ends = lambda e: stored(components(e))
    labels = ends(edges)
    labelled = prints.join(labels, "node", "left").select("node", "mark", "fp", F.coalesce("component", "node").alias("label"))
    pairs = block_links(rows, radius, total, True, labelled).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = stored(pairs.join(found, ["a", "b"], "left_anti"))
    passes = -(-rest.count() // max(REST, total))
    for k in range(passes):
        part = rest.where(F.pmod(F.xxhash64("a", "b"), F.lit(passes)) == k)
        if k:
            labels = ends(edges)
            for c in ("a", "b"):
                part = part.join(labels.select(F.col("node").alias(c), F.col("component").alias(f"_{c}")), c, "left")
            part = part.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b")
        more = stored(edges.unionByName(verify(stored(part))))
        drop_stored(labels)
        drop_stored(edges)
        edges = more
    drop_stored(rest)
    return edges


def near_components(prints: DataFrame, radius: int, keys: Column, verify: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """doc_id, fp, component_id of each row of the stored prints; keys: column of block keys for a fingerprint's row; verify: keeps the pairs (a, b) that link."""
    more = "bands" if "bands" in prints.columns else "bits"
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.first(more).alias(more), F.count(F.lit(1)).alias("copies"))
    distinct = distinct.withColumn("node", F.col("bits") if more == "bits" else F.col("first"))  # of 64 bits the fingerprint itself: rows without doc_id pass links on
    known = stored(distinct.where("node is not null").select("node", F.xxhash64("fp").alias("mark"), "fp", more))
    rows, fps = known.select(F.explode(keys).alias("key"), "node", "mark"), known.select("node", "mark", "fp")
    total = prints.count()
    edges = stored(block_links(rows, radius, total, verify is not None, fps))
    if verify:
        found = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        drop_stored(edges)
        edges = rest_links(rows, fps, stored(verify(found)), found, radius, total, verify)
        drop_stored(found)
    drop_stored(known)
    joined = components(edges)
    drop_stored(edges)
    linked = stored(joined.union(joined.select("component", "component").distinct()))
    low = linked.join(distinct.where("node is not null").select("node", "first"), "node").groupBy("component").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n"))
    named = join_counted(linked, low, ["component"], linked.count(), "n").select("node", "component_id")
    tied = distinct.join(named, "node", "left").select("fp", "copies", F.coalesce("component_id", "first").alias("component_id"))
    return join_counted(prints.select("doc_id", "fp", *(["bits"] if more == "bits" else [])), tied, ["fp"], total, "copies")


def simhash_components(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of each row under 64-bit fingerprints."""
    prints = stored(fingerprints(docs, words))
    parts = near_components(prints, radius, part_keys(radius))
    return parts.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def bit_differs(shared: int, a: int, b: int) -> float:
    """Chance that a fingerprint bit differs between sets that share so many shingles and have a and b of their own."""
    heads = lambda n: [math.comb(n, k) / 2**n for k in range(n + 1)]
    total = 0.0
    for k, p in enumerate(heads(shared)):
        x, y = (sum(q for m, q in enumerate(heads(n)) if 2 * (k + m) > shared + n) for n in (a, b))
        total += p * (x * (1 - y) + y * (1 - x))
    return total


@lru_cache
def wide_radius(similarity: float, bits: int = 64 * WIDE_WORDS) -> int:
    """Differing bits to expect of two sets at that similarity or above, in the worst case of few shingles or many, and three standard errors more."""
    worst = math.acos(2 * similarity / (1 + similarity)) / math.pi
    for n in range(1, 40):
        own = int(n / similarity - n + 1e-9)
        worst = max([worst, *(bit_differs(n, a, own - a) for a in range(own // 2 + 1))])
    return round(bits * worst + 3 * math.sqrt(bits * worst * (1 - worst)))


def keep_first(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows, all columns, without those near an earlier one: the smallest doc_id of each component of near pairs stays.

    Wide fingerprints find the pairs, and their texts' exact Jaccard similarity confirms them. Rows that share a doc_id are one
    document and stay or go together; rows without doc_id stay; empty texts, null ones among them, are copies of each
    other; an empty table gives an empty one.
    """
    prints = stored(fingerprints(docs, words, wide=True))
    verify = lambda pairs: similar_pairs(pairs, docs, words, similarity)
    parts = near_components(prints, wide_radius(similarity), F.col("bands"), verify)
    going = stored(parts.where("doc_id <> component_id").select("doc_id").distinct())  # its size is known then, and while it is small no text is shuffled
    return docs.join(going, "doc_id", "left_anti").select(*docs.columns)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
