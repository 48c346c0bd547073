import hashlib
from collections import Counter

import public_tokenizers
import sentencepiece
from pyspark.sql import types as T
from tokenizers import Tokenizer

from lociweave.llm import alignment as A
from tests.llm.test_packing import TRICKY
from tests.llm.test_token_counts import MORE

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("links", T.StringType()), T.StructField("block", T.IntegerType())])
OWN = ["▁", "a ▁b", "<s> x </s> <unk>", "a <0x0A> b", "x\x1c y\x1d\x1e z", "a\x00b \x00 c", " lead", "trail ", "  two  ", "\n\n a\n b", " x   y　z", "\U0001f600\U0001f469‍\U0001f4bb ok", "don 't 'll x's", "x" * 3000, "many " * 20_000, "ÿþ é x", "a▁▁b", "1 000 000,5"]


def tools():
    if not hasattr(tools, "it"):
        a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        a.encode_special_tokens = True
        b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in visible]
        letter = {chr(x): x for x in visible} | {chr(256 + k): x for k, x in enumerate(hidden)}
        tools.it = a, b, letter
    return tools.it


def tokens(text):
    """Whole encodings: ids of A and B, and the places where their tokens end; nothing where the bytes differ."""
    a, b, letter = tools()
    raw = (" " + (text or "")).encode()
    one, two = a.encode(" " + (text or ""), add_special_tokens=False), b.encode(text or "")
    a_bytes = [bytes(letter[c] for c in t) for t in one.tokens]
    pieces = [b.id_to_piece(i) for i in two]
    b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(two, pieces, strict=True)]
    if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
        return [], [], [], []
    ends = lambda xs: [sum(map(len, xs[: k + 1])) for k in range(len(xs))] if len(xs) < 500 else list(__import__("itertools").accumulate(map(len, xs)))
    return one.ids, two, ends(a_bytes), ends(b_bytes)


def plain(docs):
    made, count = [], Counter()
    for d, text in docs:
        a, b, ea, eb = tokens(text)
        at = {e: k for k, e in enumerate(eb)}
        links = [(k, at[e]) for k, e in enumerate(ea) if e in at]
        pairs = [(a[i], b[j]) for i, j in links]
        count.update(pairs)
        groups, i0, j0 = [], 0, 0
        for i, j in links:
            groups.append(",".join(map(str, a[i0 : i + 1])) + "|" + ",".join(map(str, b[j0 : j + 1])))
            i0, j0 = i + 1, j + 1
        made.append((d, len(a), len(b), pairs, ";".join(groups)))
    top = Counter()
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    sha = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    return [(d, na, nb, len(p), len(p), sum(count[x] == top[x[1]] for x in p), sum(count[x] for x in p), sha(g)) for d, na, nb, p, g in made], made


def key(r):
    return (r[0] is None, r[0] or 0, r[1:])


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, A.op13_tokenizer_alignment(spark, sf_dir).collect()), key=key) == sorted(plain(docs)[0], key=key)


def test_tricky_texts_and_cases(spark, monkeypatch):
    docs = [*enumerate([*TRICKY, *MORE, *OWN]), (None, "one two"), (None, None), (3, "again and again"), (3, "again and again")]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS)
    want, made = plain(docs)
    assert any(w[1] == 0 and d[1] for w, d in zip(want, docs, strict=True)) and sum(w[1] > 0 for w in want) > 40
    out = A.align(df)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)
    assert sorted(map(tuple, A.token_groups(df).collect()), key=key) == sorted(((d, na, nb, g) for d, na, nb, _, g in made), key=key)
    assert A.align(df.limit(0)).count() == 0


def test_a_cache_that_is_cleared(monkeypatch):
    monkeypatch.setattr(A, "CACHE_CHARS", 50)
    one = A.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    for text in ["plain words of text", "other words", "plain words again", "x" * 100, "plain"]:
        (places,) = one.of([text])
        a, b, _, _ = tokens(text)
        assert sum(one.sizes[4 * p] for p in places) == len(a) and sum(one.sizes[4 * p + 1] for p in places) == len(b)
        assert b"".join(one.groups[p] for p in places)[:-1].decode() == plain([(0, text)])[1][0][4]


def test_one_block_a_document(spark, monkeypatch):
    blocks = [(0, 5, "the cat"), (1, 6, "the dog"), (2, 7, "the cat the cat")]
    df = spark.createDataFrame([(d, t, None, None) for _, d, t in blocks], DOCS).repartition(3)
    want, _ = plain([(d, t) for _, d, t in blocks])
    assert sorted(map(tuple, A.align(df).collect()), key=key) == sorted(want, key=key)


def test_texts_without_tokens_in_many_blocks_of_a_task(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_CHARS", 10)
    texts = [None, None, "", "one two three", None, "four five six seven", "a▁▁b and more", "", "eight nine ten", "▁", "one two eleven", None]
    df = spark.createDataFrame([(k, t, None, None) for k, t in enumerate(texts)], DOCS).coalesce(1)
    out = A.align(df)
    assert sorted(map(tuple, out.collect()), key=key) == sorted(plain(list(enumerate(texts)))[0], key=key)
    assert sorted(map(tuple, A.align(df.where("text is null or text = ''")).collect()), key=key) == [(k, 0, 0, 0, 0, 0, 0, "") for k, t in enumerate(texts) if not t]
