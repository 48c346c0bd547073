"""Operator 1: benchmark decontamination by q-gram lemma filtering.

An occurrence of an item of m characters with at most e = floor(EDITS x m) edits
shares at least m - q + 1 - q e of its q-grams with the document, on at most e + 1 neighbouring
diagonals (place in the document less place in the item). So per document and item
the shared q-grams are counted in overlapping bands of diagonals, twice e + 1 wide at distances of
e + 1; bands that reach the bound are kept, and there the item is aligned within the
band, giving up once all cells of a row exceed the budget. Nothing within the budget is lost.

Both sides are compared in lower case with runs of blanks as one. q is Q, or for short items the largest
that leaves a shared q-gram to expect, so items of any length but none have the same budget; items of
different q have q-gram tables of their own.

The items are a query set that all documents are held against: they travel to the
tasks in blocks of about BLOCK_CHARS characters, dealt by Spark. One block, checked by a sum of lengths, is
a single pass; of more, each has a pass whose findings are written before the next block leaves the
driver, so that neither the driver, a task nor the plan holds more than one.

Input cases: null and empty texts and items match nothing; repeated documents or items give
repeated rows; very long texts are processed whole, on their own; empty tables: empty
result; other columns are ignored by find_leaks and kept by keep_clean, which judges each row by its text alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_salted, stored, table, tidy
from .token_counts import text_groups

Q = 8
EDITS = 0.1
BLOCK_CHARS = 4_000_000
RUN_CHARS = 1_000_000
FILTER_BITS = 22
_P = 0x9E3779B97F4A7C15


def normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case with runs of blanks as one, and their places in the text."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4")
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13)) | (codes == 0xA0)
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return np.where(blank, np.uint32(32), codes)[keep], np.nonzero(keep)[0]


def grams(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """A hash of each run of q codes: lengths double, or grow by one, along the binary digits of q."""
    h = one = codes.astype(np.uint64) + np.uint64(1)
    if len(h) < q:
        return h[:0]
    n, p = 1, _P
    for digit in f"{q:b}"[1:]:
        h = h[:-n] * np.uint64(p) + h[n:]
        n, p = 2 * n, p * p % (1 << 64)
        if digit == "1":
            h = h[:-1] * np.uint64(_P) + one[n:]
            n, p = n + 1, p * _P % (1 << 64)
    h ^= h >> np.uint64(32)
    return h * np.uint64(0xD6E8FEB86659FD93)


def budget(m: int, edits: float = EDITS) -> tuple[int, int, int]:
    """Edits allowed for an item of m characters, the length of its q-grams, and how many must then be shared."""
    e = int(edits * m)
    q = max(1, min(Q, m // (e + 1)))
    return e, q, m - q + 1 - q * e


class Grams:
    """The q-grams, of one length, of some items: where each occurs."""

    def __init__(self, q: int, items: list[int], codes: list[np.ndarray]) -> None:
        self.q = q
        g = [grams(codes[k], q) for k in items]
        every = np.concatenate(g)
        item = np.repeat(np.array(items), [len(x) for x in g])
        place = np.concatenate([np.arange(len(x)) for x in g])
        order = np.argsort(every, kind="stable")
        self.grams, self.first, self.times = np.unique(every[order], return_index=True, return_counts=True)
        self.item, self.place = item[order], place[order]
        self.marked = np.zeros(1 << FILTER_BITS, bool)
        self.marked[self.grams >> np.uint64(64 - FILTER_BITS)] = True

    def shared(self, joined: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """text, item and diagonal of each q-gram that a text, which begins at starts in joined, shares with an item."""
        g = grams(joined, self.q)
        at = np.nonzero(self.marked[g >> np.uint64(64 - FILTER_BITS)])[0]
        k = np.minimum(np.searchsorted(self.grams, g[at]), len(self.grams) - 1)
        same = self.grams[k] == g[at]
        at, k = at[same], k[same]
        text = np.searchsorted(starts, at, "right") - 1
        inside = at + self.q <= starts[text + 1]
        at, k, text = at[inside], k[inside], text[inside]
        times = self.times[k]
        which = np.repeat(self.first[k], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        return np.repeat(text, times), self.item[which], np.repeat(at - starts[text], times) - self.place[which]


class Items:
    """A block of items with their q-grams."""

    def __init__(self, items: list[tuple], edits: float) -> None:
        kept = [(i, normal((t or "").strip())[0]) for i, t in items]
        kept = [(i, c) for i, c in kept if len(c)]
        self.ids, self.codes = [i for i, _ in kept], [c for _, c in kept]
        self.plain = [c.tobytes() for c in self.codes]
        self.edits, lengths, self.need = np.array([budget(len(c), edits) for c in self.codes], np.int64).reshape(-1, 3).T
        self.tables = [Grams(q, np.nonzero(lengths == q)[0].tolist(), self.codes) for q in np.unique(lengths).tolist()]

    def bands(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, first diagonal, diagonals) of each band that shares enough q-grams."""
        starts, joined = np.cumsum([0, *(len(t) for t in texts)]), np.concatenate(texts)
        for table in self.tables:
            text, item, diagonal = table.shared(joined, starts)
            if len(text):
                yield from self.full_bands(text, item, diagonal)

    def full_bands(self, text: np.ndarray, item: np.ndarray, diagonal: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        low = int(max(map(len, self.codes)))
        key, count = np.unique((text * len(self.ids) + item) << 32 | (diagonal + low) // (self.edits[item] + 1), return_counts=True)
        after = np.zeros(len(key), np.int64)
        after[:-1] = np.where(key[1:] == key[:-1] + 1, count[1:], 0)
        item = (key >> 32) % len(self.ids)
        # the band that begins at a step holds it and the next; one that begins before a step without predecessor holds that step alone
        alone = np.r_[True, key[1:] != key[:-1] + 1] & (count >= self.need[item])
        for at, back in ((np.nonzero(count + after >= self.need[item])[0], 0), (np.nonzero(alone)[0], 1)):
            for x in at.tolist():
                w = int(self.edits[item[x]]) + 1
                yield int(key[x] >> 32) // len(self.ids), int(item[x]), (int(key[x] & 0xFFFFFFFF) - back) * w - low, 2 * w


def align(item: np.ndarray, text: np.ndarray, low: int, width: int, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best alignment of the whole item on diagonals low to low + width - 1, if within most."""
    d = np.arange(width)
    big = most + 1
    fits = lambda i: (low + d + i >= 0) & (low + d + i <= len(text))
    cost = np.where(fits(0), 0, big)
    start = low + d
    for i in range(1, len(item) + 1):
        at = low + d + i - 1
        there = (at >= 0) & (at < len(text))
        differ = np.where(there, text[np.clip(at, 0, len(text) - 1)] != item[i - 1], True)
        new = cost + np.where(there, differ, big)
        came = start
        skip = np.r_[cost[1:] + 1, big]
        came = np.where(skip < new, np.r_[start[1:], 0], came)
        new = np.where(fits(i), np.minimum(new, skip), big)
        run = np.minimum.accumulate(new - d) + d
        source = np.maximum.accumulate(np.where(new <= run, d, 0))
        cost, start = np.minimum(run, big), came[source]
        if cost.min() > most:
            return None
    k = int(cost.argmin())
    return int(cost[k]), max(0, int(start[k])), min(len(text), low + k + len(item))


def within(item: np.ndarray, text: np.ndarray, low: int, width: int, most: int) -> bool:
    """Whether align finds something; places outside the text equal no character, and to cross them costs an edit each as leaving out characters of the item does."""
    padded = np.zeros(width + len(item), text.dtype)
    a, b = max(0, low), min(len(text), low + len(padded))
    padded[a - low : b - low] = text[a:b]
    d = np.arange(width)
    cost = np.zeros(width, np.int64)
    for i, c in enumerate(item.tolist()):
        new = cost + (padded[i : i + width] != c)
        np.minimum(new[:-1], cost[1:] + 1, out=new[:-1])
        new -= d
        cost = np.minimum.accumulate(new)
        cost += d
        if i % 4 == 3 and int(cost.min()) > most:
            return False
    return int(cost.min()) <= most


def leaks_in(items: Items, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) of the best occurrence of each item in each text, in the texts' own places."""
    codes, places = zip(*(normal(t) for t in texts), strict=True)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for t, k, low, width in items.bands(list(codes)):
        if best.get((t, k), (1,))[0] == 0:
            continue
        item, e = items.codes[k], int(items.edits[k])
        a = max(0, low)
        near = codes[t][a : low + width + len(item) + 1].tobytes()
        at = near.find(items.plain[k])
        while at % 4 and at >= 0:
            at = near.find(items.plain[k], at + 1)
        if at >= 0:
            found = (0, a + at // 4, a + at // 4 + len(item))
        else:
            found = align(item, codes[t], low, width, e) if within(item, codes[t], low, width, e) else None
        if found and found < best.get((t, k), (e + 1,)):
            best[t, k] = found
    return [(t, k, int(places[t][s]), int(places[t][x - 1]) + 1, e) for (t, k), (e, s, x) in sorted(best.items()) if x > s]


def item_blocks(benchmark: DataFrame) -> tuple[int, Iterator[list[tuple]]]:
    """The number of blocks of items, and the blocks, read one at a time."""
    items = benchmark.where("text is not null").select("item_id", "text")
    blocks = -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK_CHARS)
    if blocks <= 1:
        return blocks, iter([[(r[0], r[1]) for r in items.collect()]] * blocks)
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    dealt = stored(dealt.repartitionByRange(blocks, "block").sortWithinPartitions("block"))  # so that a block's rows are read alone
    return blocks, ([(r[0], r[1]) for r in dealt.where(F.col("block") == k).collect()] for k in range(blocks))


def found_in(docs: DataFrame, key: list[str], block: list[tuple], edits: float, item_type: str) -> DataFrame:
    """The key columns with item_id, start, end, edits of each finding of the block's items in the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    schema = docs.select(*key).schema.add("item_id", item_type).add("start", "integer").add("end", "integer").add("edits", "integer")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(shared.value, edits)
        for b in batches:
            rows, at = [], 0
            for run in text_groups([t or "" for t in b.column(len(key)).to_pylist()], RUN_CHARS):
                rows += [(at + t, items.ids[k], s, x, e) for t, k, s, x, e in leaks_in(items, run)]
                at += len(run)
            row = pa.array([r[0] for r in rows], pa.int64())
            columns = [pa.array([r[1] for r in rows], pa.string() if item_type == "string" else pa.int64()), *(pa.array([r[c] for r in rows], pa.int32()) for c in (2, 3, 4))]
            yield pa.RecordBatch.from_arrays([*(c.take(row) for c in b.columns[: len(key)]), *columns], schema.fieldNames())

    return docs.select(*key, "text").mapInArrow(tidy(scan), schema)


def all_found(docs: DataFrame, key: list[str], benchmark: DataFrame, edits: float) -> DataFrame:
    kind = "string" if benchmark.schema["item_id"].dataType.simpleString() == "string" else "long"
    blocks, items = item_blocks(benchmark)
    out = found_in(docs.limit(0), key, [], edits, kind) if not blocks else None
    for block in items:
        part = found_in(docs, key, block, edits, kind)
        part = stored(part) if blocks > 1 else part
        out = part if out is None else out.union(part)
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """doc_id, item_id, start, end, edits of the best place of each item in each document that has it; places are those of the text itself."""
    return all_found(docs, ["doc_id"], benchmark, edits)


def keep_clean(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """The rows, all columns, in which no item is found. Beyond one block of items, rows with a finding are told by 128 bits of their text."""
    blocks, items = item_blocks(benchmark)
    if blocks > 1:
        key = "_".join(["key", *docs.columns])  # free whatever the columns are
        digest = F.concat_ws(":", F.xxhash64("text"), F.xxhash64(F.lit(1), "text"))
        bad = all_found(docs.select(digest.alias(key), "text"), [key], benchmark, edits).select(key).distinct()
        return join_salted(docs.withColumn(key, digest), stored(bad), key, "left_anti", ["doc_id"]).select(*docs.columns)
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(next(items, []))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Items(shared.value, edits)
        for b in batches:
            keep, first = np.ones(b.num_rows, bool), 0
            for run in text_groups([t or "" for t in b.column(at).to_pylist()], RUN_CHARS):
                for t, *_ in leaks_in(held, run):
                    keep[first + t] = False
                first += len(run)
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(tidy(scan), docs.schema)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
