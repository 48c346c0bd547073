"""Operator 11: fill-in-middle transformation of whole texts, cut at line ends.

Arrow functions work on the UTF-8 bytes of a run of texts at once. A packed bit vector marks each
line's last byte, another the first byte of each code point; both have a directory of marks
before each block. The marks in a text's range are its lines n; select on the two drawn
ranks gives the byte cuts, and ranks of the cuts give lengths in code points. Hashes of
`seed:doc_id` draw ranks and form, so a document is always cut alike.

Input cases: null and empty texts stay plain (n 0, empty output); a text that holds a sentinel stays plain;
a null doc_id is drawn as an empty one; repeated rows give repeated rows; ties do not occur; an
empty table gives an empty result; other columns are ignored; a run holds texts of RUN_BYTES or one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

RUN_BYTES = 4 << 20
WORDS = 8  # 64-bit words in a block of the directory


class RankSelect:
    """A packed bit vector with the number of marks before each block."""

    def __init__(self, marks: np.ndarray) -> None:
        packed = np.packbits(marks, bitorder="little")
        self.words = np.zeros((len(packed) // (8 * WORDS) + 1, WORDS), "<u8")
        self.words.reshape(-1).view(np.uint8)[: len(packed)] = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).sum(1, dtype=np.int64))])

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Marks before each place."""
        block, word, bit = places // (64 * WORDS), places // 64 % WORDS, (places % 64).astype(np.uint64)
        words = self.words[block]
        whole = np.where(np.arange(WORDS) < word[:, None], np.bitwise_count(words), 0).sum(1, dtype=np.int64)
        own = words[np.arange(len(places)), word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[block] + whole + np.bitwise_count(own)

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """The place of the mark that has so many before it."""
        block = np.searchsorted(self.before, ranks, "right") - 1
        left = ranks - self.before[block]
        upto = np.cumsum(np.bitwise_count(self.words[block]), axis=1, dtype=np.int64)
        word = (upto <= left[:, None]).sum(1)
        at = np.arange(len(ranks))
        left = left - np.where(word > 0, upto[at, word - 1], 0)
        bits = np.unpackbits(self.words[block, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        return (block * WORDS + word) * 64 + np.argmax(np.cumsum(bits, axis=1) > left[:, None], axis=1)


def cuts(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of each text, its two byte cuts in rising order, and code points before these and before its begin.

    offsets: the begins of the texts in data and the end of the last; draws: two numbers a text, taken modulo n + 1.
    """
    begins, ends = offsets[:-1], offsets[1:]
    last = data == 10
    last[ends[ends > begins] - 1] = True
    lines = RankSelect(last)
    first = lines.rank(begins)
    n = lines.rank(ends) - first
    units = np.sort(draws % (n[:, None] + 1), axis=1)
    places = np.repeat(begins[:, None], 2, axis=1)
    some = units > 0
    places[some] = lines.select((first[:, None] + units - 1)[some]) + 1
    chars = RankSelect((data & 0xC0) != 0x80)
    points = np.stack([chars.rank(p) for p in (begins, places[:, 0], places[:, 1])], axis=1)
    return n, places, points


def byte_runs(offsets: np.ndarray, limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many bytes."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b
        a = b


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, sentinels: tuple[str, str, str] = ("<P>", "<S>", "<M>")) -> DataFrame:
    """doc_id, n (lines), form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and output for each row.

    rate: percentage of documents that are transformed; spm: percentage of these with the suffix first.
    sentinels: marks of prefix, suffix and middle.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring("_h", 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    plain = (F.col("text") == "") | (h[2] % 100 >= rate)
    for s in sentinels:
        plain = plain | F.contains("text", F.lit(s))
    form = F.when(plain, "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), digest.alias("_h")).select("doc_id", "text", form.alias("form"), h[0].alias("h1"), h[1].alias("h2"))
    p, s, m = (x.encode() for x in sentinels)

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.large_binary())
            at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            every = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            draws = np.stack([b.column(k).to_numpy() for k in (3, 4)], axis=1)
            for lo, hi in byte_runs(at):
                data, offsets = every[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
                n, places, points = cuts(data, offsets, draws[lo:hi])
                forms, raw, out = b.column(2)[lo:hi].to_pylist(), memoryview(data), []
                for kind, begin, end, (one, two) in zip(forms, offsets[:-1].tolist(), offsets[1:].tolist(), places.tolist(), strict=True):
                    prefix, middle, suffix = raw[begin:one], raw[one:two], raw[two:end]
                    parts = [raw[begin:end]] if kind == "plain" else [p, prefix, s, suffix, m, middle] if kind == "psm" else [s, suffix, p, prefix, m, middle]
                    out.append(b"".join(parts))
                none = np.array([kind == "plain" for kind in forms], bool)
                sizes = [pa.array(points[:, k + 1] - points[:, k], mask=none) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], pa.array(n), b.column(2)[lo:hi], *sizes, pa.array(out, pa.binary()).view(pa.string())], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return df.mapInArrow(transform, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(form: Column, output: Column, sentinels: tuple[str, str, str] = ("<P>", "<S>", "<M>")) -> Column:
    """The text that an output of fill_in_middle was made from."""
    parts = F.split(output, "|".join(rf"\Q{s}\E" for s in sentinels), -1)
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c, 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("form"), F.col("output"))).alias("restored_sha256"))


OP11_SQL = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS l, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
k AS (SELECT *, len(l) AS n, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS one, greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS two,
 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(l[1:one], '') AS pre, array_to_string(l[one + 1:two], '') AS mid, array_to_string(l[two + 1:n], '') AS suf FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""
