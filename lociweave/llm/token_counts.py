"""Operator 9: token counts.

Arrow functions encode batches and return lengths only. A text is cut at safe
boundaries: before a blank or line feed that a non-blank character follows. There
the byte-level pre-tokeniser always ends one unit and begins another, and no added
token holds a blank, so the counts of the pieces add up to that of the text. Equal pieces are
encoded once: a worker keeps the counts of short pieces in a cache whose size is
bounded, and sends the others to the tokeniser in batches of about equal bytes.

Input cases: a null text counts as empty (0 bytes, 0 tokens); an empty table gives
an empty result; repeated rows give repeated rows; any other columns are ignored;
a text without a safe boundary is encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

CACHE_PIECES, CACHED_CHARS, BATCH_BYTES = 400_000, 48, 1 << 20
_BOUNDARY = re.compile(r"(?<=\S)(?=[ \n]\S)")


def safe_pieces(text: str) -> list[str]:
    """Pieces whose encodings, joined, are that of the text under a byte-level pre-tokeniser."""
    words = text.split()
    gaps = len(words) - 1
    if gaps == text.count(" ") + text.count("\n") and sum(map(len, words)) + gaps == len(text) and "\0" not in text:
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")  # single blanks only: each begins a piece
    return _BOUNDARY.split(text)


def load_tokenizer(file: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(file))


def byte_batches(pieces: list[str], limit: int = BATCH_BYTES) -> Iterator[list[str]]:
    batch, size = [], 0
    for p in pieces:
        batch.append(p)
        size += len(p) * 4
        if size >= limit:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


class PieceCounter:
    """Counts tokens of texts through one tokeniser and a bounded cache of pieces."""

    def __init__(self, file: str) -> None:
        self.tokenizer = load_tokenizer(file)
        self.cache: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.cache) > CACHE_PIECES:
            self.cache.clear()
        cut = [safe_pieces(t) for t in texts]
        missing: set[str] = set()
        for pieces in cut:
            missing.update(pieces)
        missing.difference_update(self.cache)
        got, kept = {}, self.cache
        for batch in byte_batches(list(missing)):
            for piece, e in zip(batch, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False), strict=True):
                (kept if len(piece) <= CACHED_CHARS else got)[piece] = len(e)
        if not got:
            return [sum(map(kept.__getitem__, pieces)) for pieces in cut]
        return [sum(kept[p] if p in kept else got[p] for p in pieces) for pieces in cut]


def text_groups(texts: list[str], chars: int = 4_000_000) -> Iterator[list[str]]:
    """Runs of texts of about so many characters, so that what is held at once is bounded by bytes."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) for each row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for b in batches:
            counter = counter or PieceCounter(tokenizer)
            tokens: list[int] = []
            for run in text_groups([t or "" for t in b.column(1).to_pylist()]):
                tokens += counter.counts(run)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(np.array(tokens, np.int64))], ["doc_id", "n_bytes", "n_tokens"])

    df = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    df = df.mapInArrow(count, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return df.withColumn("over_limit", F.col("n_tokens") > limit)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
