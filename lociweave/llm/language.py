"""Operator 12: language of a text by rank-order profiles of n-grams.

A profile is the PROFILE most frequent character n-grams of one to SIZE letters, in order. Words are runs of
letters in lower case; an n-gram may begin or end with the one blank that stands between words, and holds none inside.
N-grams are 48-bit hashes. Learning counts all n-grams of all texts that may be learned from: Arrow functions
add them up by language in each task, Spark sums the counts and keeps the first ones of each language (the first of
64 parts of its n-grams, then of these). A text's own profile is compared with each language's: an n-gram that both hold
costs the difference of its ranks, one that the language lacks costs PROFILE. The language with the least sum wins;
score is one minus that sum's share of the largest possible one.

Input cases: null texts, empty ones and those without a letter: `und`, score 0; nothing to learn from: `und` for all;
rows without doc_id are learned from (their remainder is null) and not held out; rows without lang are not learned from; repeated rows
count each time; ties of counts go by hash, of languages by name; an empty table gives an empty result; other columns are ignored;
a long text is counted in parts, so what a task holds is its n-grams that differ.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table
from .token_counts import text_groups

SIZE, PROFILE = 5, 400
RUN_CHARS, PART = 1_000_000, 1 << 19
HELD_ENTRIES = 3_000_000  # counts that a learning task holds before it gives them out
MOST_LANGUAGES = 10_000  # profiles travel to every task: 64 MB at most, more is an error
_OWNER, _GRAM = np.uint64(48), np.uint64((1 << 48) - 1)
BLANK = 32


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@lru_cache(1)
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts in lower case, one blank before the first word and after each, and the text that each belongs to."""
    low = [t.lower() for t in texts]
    codes = np.frombuffer((" ".join(low) + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = letters()[codes]
    kept = is_letter.copy()
    kept[1:] |= is_letter[:-1]
    owner = np.repeat(np.arange(len(low), dtype=np.uint64), [len(t) + 1 for t in low])[kept]
    codes = np.where(is_letter, codes, BLANK)[kept]
    return np.concatenate([[BLANK], codes]).astype(np.uint64), np.concatenate([[0], owner]).astype(np.uint64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def tallied(texts: list[str], owners: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Keys (owner in the upper 16 bits, hash of the n-gram in the lower 48) in order, and how often each occurs. owners: of each text, its place if not given."""
    codes, owner = words(texts)
    if owners is not None:
        owner = owners[owner]
    found = []
    for a in range(0, len(codes) - 1, PART):
        c = codes[a : a + PART + SIZE]
        n = min(PART, len(codes) - 1 - a)  # starts of this part; the last code is a blank and starts none
        blank = c == BLANK
        nearest = np.where(blank, np.arange(len(c)), len(c))
        nearest = np.minimum.accumulate(nearest[::-1])[::-1]
        longest = np.minimum(nearest[1 : n + 1] - np.arange(n) + 1, SIZE)  # up to the word's closing blank
        begins = owner[a + np.arange(n) + blank[:n]] << _OWNER
        parts, h = [], np.zeros(len(c), np.uint64)
        for size in range(1, SIZE + 1):
            h = h[: len(c) - size + 1] * np.uint64(0x9E3779B97F4A7C15) + c[size - 1 :]
            able = longest[: len(h)] >= size
            if size == 1:
                able = able & ~blank[:n]
            at = np.flatnonzero(able)
            x = h[at] + np.uint64(size)
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            parts.append(begins[at] | ((x ^ (x >> np.uint64(29))) & _GRAM))
        keys = np.sort(np.concatenate(parts))
        if len(keys):
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            found.append((keys[first], np.diff(np.append(first, len(keys)))))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return found[0] if len(found) == 1 else summed(*map(np.concatenate, zip(*found, strict=True)))


def leading(keys: np.ndarray, counts: np.ndarray, n: int, width: int = PROFILE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each of n owners the `width` most frequent n-grams, ties by hash: owner, n-gram, rank from 0.

    keys are in order. A histogram of counts finds the count of the last one that fits; only what is above it or first among its equals is sorted.
    """
    owner, top = (keys >> _OWNER).astype(np.int64), 255
    low = np.minimum(counts, top)
    at_least = np.bincount(owner * (top + 1) + low, minlength=n * (top + 1)).reshape(n, top + 1)[:, ::-1].cumsum(1)[:, ::-1]
    bar = np.maximum((at_least >= width).sum(1) - 1, 1)
    room = width - np.where(bar < top, at_least[np.arange(n), np.minimum(bar + 1, top)], 0)
    equal = low == bar[owner]
    run = np.cumsum(equal)
    begins = np.searchsorted(owner, np.arange(n))
    earlier = np.concatenate([[0], run])[begins]
    few = at_least[:, 0] < width
    keep = np.flatnonzero((low > bar[owner]) | (equal & ((run - earlier[owner] <= room[owner]) | (bar[owner] == top) | few[owner])))
    keep = keep[np.lexsort((-counts[keep], owner[keep]))]
    owner = owner[keep]
    rank = np.arange(len(keep)) - np.searchsorted(owner, np.arange(n))[owner]
    inside = rank < width
    return owner[inside], keys[keep[inside]] & _GRAM, rank[inside]


@dataclass
class Profiles:
    """languages in order of name; grams: n-grams of any profile, in order; ranks: of each language and gram, or -1."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray

    def judge(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        owner, gram, rank = leading(*tallied(texts), len(texts))
        size = np.bincount(owner, minlength=len(texts))
        if not self.languages or not len(owner):
            return ["und"] * len(texts), np.zeros(len(texts))
        at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        known = self.grams[at] == gram
        cost = np.stack([np.bincount(owner, np.where(known & (own[at] >= 0), np.abs(rank - own[at]), PROFILE), len(texts)) for own in self.ranks])
        best = cost.argmin(0)
        score = 1 - cost.min(0) / np.maximum(size * PROFILE, 1)
        return [self.languages[k] if s else "und" for k, s in zip(best.tolist(), size.tolist(), strict=True)], np.where(size > 0, score, 0.0)


def learn(docs: DataFrame, text: str = "text", language: str = "lang") -> Profiles:
    """Profiles of the languages of all rows that have one."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def given() -> Iterator[pa.RecordBatch]:
            keys, counts = summed(*map(np.concatenate, zip(*held, strict=True)))
            known = pa.array(list(names))
            for a in range(0, len(keys), 200_000):
                k = keys[a : a + 200_000]
                yield pa.RecordBatch.from_arrays([known.take(pa.array((k >> _OWNER).astype(np.int64))), pa.array((k & _GRAM).astype(np.int64)), pa.array(counts[a : a + 200_000])], ["lang", "gram", "n"])

        for b in batches:
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            at = 0
            for run in text_groups(texts, RUN_CHARS):
                if len(names) + len(run) > 60_000 and held:  # owners have 16 bits
                    yield from given()
                    held, size = [], 0
                    names.clear()
                owners = np.array([names.setdefault(x, len(names)) for x in langs[at : at + len(run)]], np.uint64)
                at += len(run)
                held.append(tallied(run, owners))
                size += len(held[-1][0])
                if size > HELD_ENTRIES:
                    held = [summed(*map(np.concatenate, zip(*held, strict=True)))]
                    size = len(held[0][0])
                    if size > HELD_ENTRIES // 2:
                        yield from given()
                        held, size = [], 0
        if held:
            yield from given()

    able = docs.where(F.col(language).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(language).alias("lang"))
    counts = able.mapInArrow(tally, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    first = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.col("n").desc(), "gram"))
    few = counts.withColumn("_part", F.pmod("gram", F.lit(64))).withColumn("_r", first("lang", "_part")).where(F.col("_r") <= PROFILE)
    few = few.withColumn("_r", first("lang")).where(F.col("_r") <= PROFILE).select("lang", "gram", F.col("_r").alias("r"))
    rows = few.limit(MOST_LANGUAGES * PROFILE + 1).toPandas()
    if len(rows) > MOST_LANGUAGES * PROFILE:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(rows["lang"].unique().tolist())
    place = {x: k for k, x in enumerate(languages)}
    grams, at = np.unique(rows["gram"].to_numpy(np.uint64), return_inverse=True)
    ranks = np.full((len(languages), len(grams)), -1, np.int32)
    ranks[[place[x] for x in rows["lang"]], at] = rows["r"].to_numpy(np.int32) - 1
    return Profiles(languages, grams, ranks)


def predict(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """doc_id, lang_pred, score for each row."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names: list[str] = []
            scores = [np.zeros(0)]
            for run in text_groups(b.column(1).to_pylist(), RUN_CHARS):
                got, score = profiles.judge(run)
                names += got
                scores.append(score)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(np.concatenate(scores))], ["doc_id", "lang_pred", "score"])

    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return df.mapInArrow(judge, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = predict(docs, learn(docs.where(~held_out(F.col("doc_id")))))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
