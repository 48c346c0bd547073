"""Operator 7: toxicity by a character n-gram linear classifier on naive Bayes log-count ratios.

Training uses labelled rows only, and of these a bounded sample: the first
SAMPLE_ROWS of each class by a hash of doc_id (a documented bound; the sampled ids are few enough to
broadcast; of rows that share a doc_id the first text in order is learned from). Texts are lower-cased, blanks between words become single ones, and
character n-grams of the sizes in SIZES are hashed to 2^BITS features, present or absent in a document. Spark counts the documents of
each class that hold a feature; of those in MIN_DF or more of the documents, the MAX_FEATURES with the
largest log-count ratios by amount stay. Presence times ratio is the input of a logistic regression with an L2
penalty, fitted on the sample. Scoring walks every whole text in Arrow batches.

Input cases: null and empty texts get the score of no feature; rows without
doc_id or label are not learned from; several labels of a document: the highest
holds; no labelled rows of both classes: every score is 0; an empty table gives an empty result; other
columns are ignored by score and kept by keep_clean.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_stored, stored, table, tidy
from .token_counts import text_groups

SIZES = (3, 4, 5)
BITS = 21
SAMPLE_ROWS = 2000
MIN_DF = 0.004
MAX_FEATURES = 1000
THRESHOLD = 0.7
RUN_CHARS = 1_000_000


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def normal(text: str) -> str:
    return " " + " ".join(text.lower().split()) + " "


def hashed(texts: list[str], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of each n-gram occurrence; with `wanted`, a table by feature, of the features it marks only."""
    joined = [normal(t) for t in texts]
    ends = np.cumsum([len(t) for t in joined])
    codes = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32) + np.uint32(1)
    rows, features = [], []
    rolled = codes * np.uint32(2654435761)
    for n in range(2, max(SIZES) + 1):
        rolled = rolled[:-1] * np.uint32(1000003) + codes[n - 1 :] * np.uint32(2246822519) if len(rolled) > 1 else rolled[:0]
        if n not in SIZES:
            continue
        f = ((rolled ^ (rolled >> np.uint32(15))) * np.uint32(2246822519) + np.uint32(n)) >> np.uint32(32 - BITS)
        at = np.nonzero(wanted[f])[0] if wanted is not None else np.arange(len(f))
        row = np.searchsorted(ends, at, "right")
        inside = at + n <= ends[row] if len(at) else np.zeros(0, bool)
        rows.append(row[inside])
        features.append(f[at[inside]])
    return np.concatenate(rows), np.concatenate(features).astype(np.int64)


def present(texts: list[str], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature)."""
    row, feature = hashed(texts, wanted)
    key = np.unique((row << BITS) | feature)
    return key >> BITS, key & ((1 << BITS) - 1)


@dataclass
class Model:
    """weights: of each hashed feature that is used."""

    bias: float
    features: np.ndarray
    weights: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        by_feature = np.zeros(1 << BITS, np.float32)
        by_feature[self.features] = self.weights
        return self._scores(texts, by_feature)

    def _scores(self, texts: list[str], by_feature: np.ndarray) -> np.ndarray:
        row, feature = present(texts, by_feature != 0)
        z = self.bias + np.bincount(row, by_feature[feature], len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_logistic(rows: np.ndarray, cols: np.ndarray, x: np.ndarray, y: np.ndarray, width: int, penalty: float = 1.0, steps: int = 1000) -> tuple[float, np.ndarray]:
    """L2-penalised logistic regression over sparse entries, by accelerated gradient steps."""
    weight = np.where(y > 0, len(y) / (2 * max(1, y.sum())), len(y) / (2 * max(1, len(y) - y.sum())))
    norm = np.bincount(rows, x * x, len(y))
    rate = 1 / (0.25 * weight.max() * (norm.max(initial=0) + 1) + penalty / len(y))
    rate = max(rate, 1 / (0.25 * weight.max() * (np.mean(norm) * 4 + 1)))
    b, w, pb, pw = 0.0, np.zeros(width), 0.0, np.zeros(width)
    for t in range(1, steps + 1):
        m = (t - 1) / (t + 2)
        vb, vw = b + m * (b - pb), w + m * (w - pw)
        z = vb + np.bincount(rows, x * vw[cols], len(y))
        g = weight * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) / len(y)
        pb, pw = b, w
        b = vb - rate * g.sum()
        w = vw - rate * (np.bincount(cols, x * g[rows], width) + penalty * vw / len(y))
    return b, w


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """The model of the labelled rows that are not held out; None unless both classes occur."""
    able = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"))
    able = able.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    first = lambda kind: able.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    chosen = stored(first(1).union(first(0)))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = stored(rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic")).select("text", "toxic"))  # one row a document
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = sizes.get(1, 0), sizes.get(0, 0)
    if not n_pos or not n_neg:
        return None

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int32)
        for b in batches:
            texts, toxic = b.column(0).to_pylist(), np.array(b.column(1).to_pylist(), np.int64)
            at = 0
            for run in text_groups(texts, RUN_CHARS):
                row, feature = present(run)
                for kind in (0, 1):
                    counts[kind] += np.bincount(feature[toxic[at + row] == kind], minlength=1 << BITS).astype(np.int32)
                at += len(run)
        some = np.nonzero(counts.sum(0))[0]
        for k in range(0, len(some), 100_000):
            part = some[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[1][part]), pa.array(counts[0][part])], ["feature", "pos", "neg"])

    found = sample.mapInArrow(tidy(tally), "feature long, pos int, neg int").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    ratio = F.log((F.col("pos") + 1) / F.lit(n_pos + 2.0)) - F.log((F.col("neg") + 1) / F.lit(n_neg + 2.0))
    least = max(3, math.ceil(MIN_DF * (n_pos + n_neg)))
    top = found.where(F.col("pos") + F.col("neg") >= least).withColumn("r", ratio).where("abs(r) >= 0.5")
    top = top.orderBy(F.abs("r").desc(), "feature").limit(MAX_FEATURES).select("feature", "r").toPandas()
    features, ratios = top["feature"].to_numpy(np.int64), top["r"].to_numpy(float)
    wanted = np.zeros(1 << BITS, bool)
    wanted[features] = True

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.zeros(1 << BITS, bool)
        marked[features] = True
        for b in batches:
            at, out = 0, []
            for run in text_groups(b.column(0).to_pylist(), RUN_CHARS):
                row, feature = present(run, marked)
                out += np.split(feature, np.searchsorted(row, np.arange(1, len(run))))
                at += len(run)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int64())), b.column(1)], ["features", "toxic"])

    rows = sample.mapInArrow(tidy(entries), "features array<long>, toxic int").toPandas()
    y = rows["toxic"].to_numpy(float)
    lengths = [len(f) for f in rows["features"]]
    order = np.argsort(features)
    flat = np.concatenate([np.asarray(f, np.int64) for f in rows["features"]]) if sum(lengths) else np.zeros(0, np.int64)
    cols = order[np.searchsorted(features[order], flat)] if len(flat) else flat
    bias, w = fit_logistic(np.repeat(np.arange(len(y)), lengths), cols, ratios[cols], y, len(features))
    drop_stored(sample)
    drop_stored(chosen)
    return Model(float(bias), features, (w * ratios).astype(np.float32))


def with_scores(docs: DataFrame, model: Model | None, columns: list[str], name: str = "score") -> DataFrame:
    """The columns, with the score of each row's text under the name."""
    kept = docs.select(*columns, *([] if "text" in columns else ["text"]))
    names = kept.columns
    at = names.index("text")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_feature = np.zeros(1 << BITS, np.float32)
        if model:
            by_feature[model.features] = model.weights
        for b in batches:
            out = [np.zeros(0)]
            for run in text_groups([t or "" for t in b.column(at).to_pylist()], RUN_CHARS):
                out.append(model._scores(run, by_feature) if model else np.zeros(len(run)))
            arrays = [c for n, c in zip(names, b.columns, strict=True) if n in columns]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(np.concatenate(out))], [*columns, name])

    return kept.mapInArrow(tidy(judge), kept.select(*columns).schema.add(name, "double"))


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row."""
    out = with_scores(docs, train(docs, labels), ["doc_id"])
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, all columns, whose score is below the threshold."""
    name = "_".join(["score", *docs.columns])  # free whatever the columns are
    return with_scores(docs, train(docs, labels), docs.columns, name).where(F.col(name) < threshold).drop(name)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
