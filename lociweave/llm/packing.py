"""Operator 10: best-two-fit packing of documents into token sequences.

1. Arrow functions encode the texts. A text is cut at blanks and line feeds, which
   the word tokeniser drops and no added token or unit spans, so joined encodings of the words are
   that of the text; equal words are encoded once. A document's ids and the end
   id are cut into pieces of at most the sequence length; of the ids only their
   checksum leaves the task.
2. The pieces, a few numbers each, are written to the shared folder and counted.
3. Full pieces are sequences of their own. The others go, by a hash of their
   place in that table (so that equal rows part as well), to groups of about GROUP_PIECES pieces, whose number follows the input.
   Each group is packed alone: a bin takes the longest piece left, then again and again the longest
   that fits; where a gap remains, its smallest piece gives way to the two unpacked
   pieces that fit the widened gap most tightly. A group wastes less than one
   sequence against packing all at once.

Input cases: null or empty text: one piece of the end id only; repeated rows are
separate documents; null doc_ids stay; empty table: empty result; other
columns are ignored. Ties are broken by length, then doc_id, piece and checksum.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table
from .token_counts import CACHED_CHARS, load_tokenizer, text_groups

GROUP_PIECES = 8192
CACHE_WORDS = 800_000
LAST_LETTER = "\u024f"


def byte_level() -> dict[int, str]:
    """How the byte-level pre-tokeniser writes the letters from U+0080 to LAST_LETTER: each byte as a visible character."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    char = {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return {c: "".join(char[b] for b in chr(c).encode()) for c in range(0x80, ord(LAST_LETTER) + 1)}


#: How the tokeniser normalises and cuts a text; WordEncoder does the same for plain words.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
CUTS = [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


class WordEncoder(dict):
    """Word to ids, as little-endian 32-bit bytes; a word is encoded when it is first asked for.

    A word of letters that are up to LAST_LETTER in lower case too (some capitals' small
    letters lie beyond it), a full stop or comma after it or not, needs
    neither normalising, other than lower case, nor cutting: it goes to the
    tokeniser's model straight away. Any other goes through the whole tokeniser.
    """

    def __init__(self, file: str) -> None:
        self.tokenizer = load_tokenizer(file)
        made = json.loads(self.tokenizer.to_str())
        if (made["normalizer"] or {}).get("normalizers") != NORMALIZERS or (made["pre_tokenizer"] or {}).get("pretokenizers") != CUTS:
            raise ValueError(f"{file}: words can only be encoded apart where blanks are dropped and words cut as in word_bpe_49k.json")
        self.model, self.letters = self.tokenizer.model, byte_level()
        self.ends = {c: self.whole(c) for c in ".,"} | {"": b""}

    def whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        core = word[:-1] if word[-1:] in (".", ",") else word
        low = core.lower()
        if core.isalpha() and (low.isascii() or max(low) <= LAST_LETTER) and max(core) <= LAST_LETTER and "\u0130" not in core:
            ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(low.translate(self.letters))]) + self.ends[word[len(core) :]]
        else:
            ids = self.whole(word)
        if len(word) <= CACHED_CHARS:
            self[word] = ids
        return ids

    def ids(self, texts: list[str]) -> list[bytes]:
        if len(self) > CACHE_WORDS:
            self.clear()
        return [b"".join(map(self.__getitem__, t.replace("\n", " ").split(" "))) for t in texts]


@lru_cache(1)
def worker_encoder(file: str) -> WordEncoder:
    """One encoder for all tasks of a worker, so that later tasks find words encoded."""
    return WordEncoder(file)


def token_pieces(docs: DataFrame, tokenizer: str, length: int, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each document's pieces."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for b in batches:
            encoder = encoder or worker_encoder(tokenizer)
            row: list[int] = []
            out: list[tuple[int, int, int, int]] = []
            at = 0
            for run in text_groups([t or "" for t in b.column(1).to_pylist()]):
                for ids in encoder.ids(run):
                    ids += end
                    for k, start in enumerate(range(0, len(ids), 4 * length)):
                        part = ids[start : start + 4 * length]
                        row.append(at)
                        out.append((k, start // 4, len(part) // 4, zlib.crc32(part)))
                    at += 1
            piece, start, size, crc = np.array(out, np.int64).reshape(-1, 4).T
            columns = [b.column(0).take(pa.array(row, pa.int64())), *map(pa.array, (piece.astype(np.int32), start, size, crc))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


def best_two_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins, as lists of indices into lengths (each from 1 to capacity)."""
    by_length: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i in range(len(lengths) - 1, -1, -1):
        by_length[lengths[i]].append(i)
    there = sum(1 << n for n in range(1, capacity + 1) if by_length[n])  # bit n: a piece of length n is left
    mirror = sum(1 << (capacity - n) for n in range(1, capacity + 1) if by_length[n])

    def take(n: int) -> int:
        nonlocal there, mirror
        i = by_length[n].pop()
        if not by_length[n]:
            there ^= 1 << n
            mirror ^= 1 << (capacity - n)
        return i

    def put(n: int, i: int) -> None:
        nonlocal there, mirror
        if not by_length[n]:
            there |= 1 << n
            mirror |= 1 << (capacity - n)
        by_length[n].append(i)

    def pair(most: int, least: int) -> tuple[int, int] | None:
        """Two lengths left whose sum is as near to most as can be, and at least `least`."""
        for total in range(most, least - 1, -1):
            both = there & ((mirror >> (capacity - total)) if total <= capacity else (mirror << (total - capacity)))
            while both:
                a = both.bit_length() - 1
                if 2 * a < total:
                    break
                if 2 * a > total or len(by_length[a]) > 1:
                    return a, total - a
                both ^= 1 << a
        return None

    bins = []
    while there:
        held = [take(there.bit_length() - 1)]
        gap = capacity - lengths[held[0]]
        while gap and (fits := there & ((1 << (gap + 1)) - 1)):
            held.append(take(n := fits.bit_length() - 1))
            gap -= n
        if gap and there and len(held) > 1:
            small = lengths[held[-1]]  # the last put in is the smallest
            if two := pair(small + gap, small + 1):
                put(small, held.pop())
                held += [take(two[0]), take(two[1])]
        bins.append(held)
    return bins


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", length: int = 2048) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece."""
    pieces = stored(token_pieces(docs, tokenizer, length))
    n_short = pieces.where(F.col("length") < length).count()
    groups = max(1, -(-n_short // GROUP_PIECES))
    full = pieces.where(F.col("length") >= length)
    short = pieces.where(F.col("length") < length)
    short = short.withColumn("grp", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def fill(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths, grp = group["length"].to_pylist(), group["grp"][0].as_py()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for s, held in enumerate(best_two_fit(lengths, length)):
            at = 0
            for i in held:
                sequence[i], offset[i] = s, at
                at += lengths[i]
        group = group.drop_columns(["grp"]).append_column("sequence_id", pa.array((sequence * groups + grp) * 2))
        return group.append_column("offset", pa.array(offset))

    schema = short.drop("grp").schema.add("sequence_id", "long").add("offset", "long")
    packed = short.groupBy("grp").applyInArrow(fill, schema)
    alone = full.withColumns({"sequence_id": F.monotonically_increasing_id() * 2 + 1, "offset": F.lit(0).cast("long")})
    return packed.unionByName(alone)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
