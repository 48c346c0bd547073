import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from lociweave.llm import packing as P

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("piece", T.StringType())])
TRICKY = ["", None, "plain", "a  b\n\n c", "Don't stop, it's \u00c9t\u00e9 \u0130stanbul \u00aa1st", "<|endoftext|>x <|startoftext|> y<|endoftext|>", "e\u0301 \u0301a \ufb01 \uac00\u1100\u1161 \u03a3\u03a3 \u4e2d\u6587", "tab\tand\x0bother\u00a0blanks\u2003x\x1cy\x85z", "a.b, c., .d ,e x., ..", "w" * 5000 + " \u00fc" * 3000, "\u00dcber na\u00efve \u0152uvre, \u01c5 \u0149 \u017f \u212b", "''s 's 'S don'T"]


def whole_ids(text):
    t = whole_ids.__dict__.setdefault("t", Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))
    return [*t.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, docs, length):
    """Pieces are those of whole encodings, and sequences are filled without gaps."""
    want = []
    for d, text in docs:
        ids = whole_ids(text)
        for k in range(0, len(ids), length):
            part = ids[k : k + length]
            want.append((d, k // length, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= length
    return len(by), sum(r.length for r in rows)


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    bins, tokens = check(P.op10_best_fit_packing(spark, sf_dir).collect(), docs, 2048)
    assert bins <= 1.03 * -(-tokens // 2048) + 1


def test_tricky_texts_and_cases(spark):
    docs = [(k, t) for k, t in enumerate(TRICKY)] + [(None, "one two"), (3, "again again"), (3, "again again")]
    df = spark.createDataFrame([(*d, "x") for d in docs], DOCS)
    check(P.pack(df, length=16).collect(), docs, 16)
    assert P.pack(df.limit(0)).count() == 0


def test_best_two_fit():
    rng = np.random.default_rng(0)
    for case in range(30):
        lengths = rng.integers(1, 101, rng.integers(0, 400)).tolist()
        bins = P.best_two_fit(lengths, 100)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 100 for b in bins)
    # 60 + 30 leaves 10; 30 gives way to 25 + 15
    assert sorted(map(sorted, P.best_two_fit([60, 30, 25, 15], 100))) == [[0, 2, 3], [1]]


def test_equal_rows_go_to_several_groups(spark, monkeypatch):
    monkeypatch.setattr(P, "GROUP_PIECES", 16)
    rows = P.pack(spark.createDataFrame([(None, None, "x")] * 400, DOCS), length=16).collect()
    check(rows, [(None, None)] * 400, 16)
    assert len({r.sequence_id // 2 % 25 for r in rows}) > 10


def test_every_letter_of_the_short_way():
    encoder = P.WordEncoder("word_bpe_49k.json")
    letters = [c for c in map(chr, range(ord(P.LAST_LETTER) + 1)) if c.isalpha()]
    for c in letters:
        for word in (c, c + "li", "a" + c, "A" + c + "b", c + c, c + "li.", "la" + c + ","):
            assert encoder[word] == encoder.whole(word), word
    assert np.frombuffer(encoder["\u018fli"], "<u4").tolist() == [133, 247, 4250]


def test_texts_with_capitals_of_distant_small_letters(spark):
    docs = [(0, "\u018fli v\u0259 \u018fhm\u0259d. \u0181ala, \u0186d\u0254 \u0190\u028be"), (1, "\u0191\u0194\u0196 \u2c65\u023a \u023e"), (2, "plain")]
    check(P.pack(spark.createDataFrame([(*d, "x") for d in docs], DOCS), length=4).collect(), docs, 4)


def plain_bins(lengths, capacity):
    left = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    bins = []
    while left:
        held = [left.pop(0)]
        gap = capacity - lengths[held[0]]
        while (i := next((i for i in left if lengths[i] <= gap), None)) is not None:
            left.remove(i)
            held.append(i)
            gap -= lengths[i]
        if gap and len(held) > 1:
            small = lengths[held[-1]]
            fits = [(lengths[a] + lengths[b], lengths[a], -x, -y) for x, a in enumerate(left) for y, b in enumerate(left) if x < y and small < lengths[a] + lengths[b] <= small + gap]
            if fits:
                _, _, x, y = max(fits)
                two = [left[-x], left[-y]]
                left = sorted([i for i in left if i not in two] + [held.pop()], key=lambda i: (-lengths[i], i))
                held += two
        bins.append(held)
    return bins


def test_best_two_fit_against_a_plain_version():
    rng = np.random.default_rng(8)
    for case in range(40):
        lengths = rng.integers(1, rng.choice([12, 60]), rng.integers(1, 60)).tolist()
        sizes = lambda bins: sorted(sorted(lengths[i] for i in b) for b in bins)
        assert sizes(P.best_two_fit(lengths, 60)) == sizes(plain_bins(lengths, 60)), lengths


def test_other_tokenisers_are_refused():
    with pytest.raises(ValueError):
        P.WordEncoder("byte_bpe_50k.json")
