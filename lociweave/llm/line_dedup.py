"""Operator 5: repeated passages by hashing of lines and the sentences in them.

1. Arrow functions cut each whole text into units: lines, and within lines sentences; a sentence of fewer than
   UNIT_WORDS words goes together with the next, unless its own checksum or twice as many words end the unit; a long one is
   cut at every LONG_WORDS words. So most borders depend on the sentence before them alone, and a passage is cut alike wherever it stands. A unit is
   normalised (lower case, runs of blanks to one) and hashed to 128 bits; its place in the original text
   (code points, end exclusive), its number of words and its line are kept.
2. Spark groups the digests of all documents, adding up in each task first, and finds
   the earliest document, by doc_id, of each digest that others hold too. Texts are not
   shuffled; digests that very many documents share, fewer than 256 by definition, are broadcast to their units.
3. Occurrences in later documents, and any but the first in one document, return to their documents, where neighbouring
   ones form runs. A run of at least min_words words is removed, from the start of its first
   unit to the end of its last. In shorter ones whole lines that repeat are removed if they have line_words words.

op5_line_dedup reports passages (PASSAGE_WORDS, no single lines); remove_repeats takes lines of any length out as well.

Input cases: null and empty texts have no units; rows that share a doc_id are one
document: what they share with each other stays; rows without doc_id rank after all others and
count as one document; very long texts are one row up to the units; empty table: empty result;
other columns are ignored by repeated_spans and kept by remove_repeats (`removed` must be free).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_counted, stored, table

UNIT_WORDS = 6
PASSAGE_WORDS = 20
MIN_WORDS, LINE_WORDS = 8, 1
LAST = (1 << 63) - 1
LONG_WORDS = 24
_WORD = re.compile(r"\S+")
_SENTENCE_END = re.compile(r"(?<=[.!?])(?=\s)")


def parts(line: str) -> Iterator[tuple[int, int, list[str], bool]]:
    """(start, end, words in lower case, whether more of its sentence follows) of each sentence, or each LONG_WORDS words of it."""
    at = 0
    for sentence in _SENTENCE_END.split(line):
        words = sentence.lower().split()
        if len(words) > LONG_WORDS:
            place = [m.span() for m in _WORD.finditer(sentence)]
            for k in range(0, len(words), LONG_WORDS):
                last = min(k + LONG_WORDS, len(words))
                yield at + place[k][0], at + place[last - 1][1], words[k:last], last < len(words)
        elif words:
            yield at + len(sentence) - len(sentence.lstrip()), at + len(sentence.rstrip()), words, False
        at += len(sentence)


def units(text: str, least: int = UNIT_WORDS) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(start, end, words, line, digest) of each unit."""
    at = 0
    for number, line in enumerate(text.split("\n")):
        words: list[str] = []
        start = end = 0
        for a, end, got, more in parts(line):
            start = start if words else a
            words += got
            if more or len(got) >= least or len(words) >= 2 * least or zlib.crc32(" ".join(got).encode("utf-8", "surrogatepass")) % 3 == 0:
                yield at + start, at + end, len(words), number, xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"))
                words = []
        if words:
            yield at + start, at + end, len(words), number, xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"))
        at += len(line) + 1


def text_key() -> Column:
    return F.xxhash64("text")


def unit_table(docs: DataFrame) -> DataFrame:
    """doc, row (of the text), place (number, words), span (start, end), line (its number, its units), h1 and h2 (digest), inner (not its first place in the text) of all units."""
    fields = ["doc", "row", "place", "span", "line", "h1", "h2", "inner"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at: list[int] = []
            numbers: list[int] = []
            digests: list[bytes] = []
            inner: list[bool] = []

            def made() -> pa.RecordBatch:
                n = np.array(numbers, np.int64).reshape(-1, 6)
                h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                rows = pa.array(at, pa.int64())
                columns = [n[:, 0] << 32 | n[:, 1], n[:, 2] << 32 | n[:, 3], n[:, 4] << 32 | n[:, 5], h[:, 0], h[:, 1], np.array(inner, bool)]
                return pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), *map(pa.array, columns)], fields)

            for r, text in enumerate(b.column(2).to_pylist()):
                seen = set()
                cut = list(units(text or ""))
                in_line = Counter(u[3] for u in cut)
                for k, (start, end, words, line, digest) in enumerate(cut):
                    at.append(r)
                    numbers += (k, words, start, end, line, in_line[line])
                    digests.append(digest)
                    inner.append(digest in seen)
                    seen.add(digest)
                if len(at) > 100_000:
                    yield made()
                    at, numbers, digests, inner = [], [], [], []
            if at:
                yield made()

    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), text_key().alias("row"), "text")
    return keyed.mapInArrow(cut, "doc long, row long, place long, span long, line long, h1 long, h2 long, inner boolean")


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, line_words: int | None = LINE_WORDS) -> DataFrame:
    """doc, row, start, end, words of each removal, and first_doc, the smallest doc that keeps something of it.

    Runs of at least min_words words; of shorter ones whole lines of at least line_words, none if that is None.
    """
    every = stored(unit_table(docs))
    outer = every.where("not inner").drop("inner")
    first = outer.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("n")).where("first < last")
    first = stored(first.select("h1", "h2", "first", "n"))
    unit = ["doc", "row", "place", "span", "line"]
    later = join_counted(outer, first, ["h1", "h2"], every.count(), "n").where("doc > first").select(*unit, "first")
    later = later.union(every.where("inner").select(*unit, F.col("doc").alias("first")))
    later = later.groupBy(*unit).agg(F.min("first").alias("first"))
    low = lambda c: F.col(c).bitwiseAND(F.lit((1 << 32) - 1))
    run = F.shiftright("place", 32) - F.row_number().over(Window.partitionBy("doc", "row").orderBy("place"))
    reach = [F.min("a").alias("a"), F.max("b").alias("b"), F.sum("words").alias("words"), F.min("first").alias("first_doc")]
    later = later.withColumn("run", run).select("doc", "row", "run", "line", F.col("span").alias("a"), F.col("span").alias("b"), low("place").alias("words"), "first")
    span = lambda c: [F.shiftright(f"{c}a", 32).cast("int").alias("start"), low(f"{c}b").cast("int").alias("end"), f"{c}words", f"{c}first_doc"]
    if line_words is None:
        runs = later.groupBy("doc", "row", "run").agg(*reach)
        return runs.where(F.col("words") >= min_words).select("doc", "row", *span(""))
    lines = later.groupBy("doc", "row", "run", "line").agg(*reach, F.count(F.lit(1)).alias("units"))
    lines = lines.withColumn("whole", F.col("units") == low("line"))
    runs = lines.withColumnRenamed("first_doc", "first").groupBy("doc", "row", "run").agg(*reach, F.collect_list(F.struct("a", "b", "words", F.col("first").alias("first_doc"), "whole")).alias("lines"))
    short = runs.where(F.col("words") < min_words).select("doc", "row", F.explode("lines").alias("x")).where(F.col("x.whole") & (F.col("x.words") >= line_words))
    return runs.where(F.col("words") >= min_words).select("doc", "row", *span("")).union(short.select("doc", "row", *span("x.")))


def with_spans(docs: DataFrame, min_words: int = MIN_WORDS, line_words: int | None = LINE_WORDS) -> DataFrame:
    """The rows and columns, and `removed`: an array of the (start, end, words) to remove, in order, or null."""
    doc, row = ("_".join([n, *docs.columns]) for n in ("doc", "row"))  # free whatever the columns are
    spans = repeated_spans(docs, min_words, line_words).groupBy(F.col("doc").alias(doc), F.col("row").alias(row))
    spans = spans.agg(F.sort_array(F.collect_list(F.struct("start", "end", "words"))).alias("removed"))
    on = (F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST)) == F.col(doc)) & (F.xxhash64(docs["text"]) == F.col(row))
    return docs.join(spans, on, "left").drop(doc, row)


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, line_words: int | None = LINE_WORDS) -> DataFrame:
    """All rows and columns, texts without their repeated spans, which `removed` lists with original offsets."""
    joined = with_spans(docs, min_words, line_words)
    at = joined.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, spans in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True):
                for s in reversed(spans or []):
                    text = text[: s["start"]] + text[s["end"] :]
                out.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if c == at else b.column(c) for c in range(b.num_columns)], b.schema.names)

    return joined.mapInArrow(cut, joined.schema)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, end, words, first_doc_id of each passage of at least PASSAGE_WORDS words that an earlier document holds."""
    spans = repeated_spans(table(spark, sf_dir, "documents"), PASSAGE_WORDS, None)
    own = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return spans.select(own("doc").alias("doc_id"), "start", "end", "words", own("first_doc").alias("first_doc_id"))
