import re
import zlib

import corpus_pipeline as C
from lociweave.llm import simhash, toxicity
from tests.llm.test_packing import check

BASE = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"\+[0-9][\x20().0-9-]+[0-9]")


def shingles(text, n=5):
    w = text.lower().split()
    return {" ".join(w[k : k + n]) for k in range(max(1, len(w) - n + 1))}


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    # toxicity: exactly the rows that the model rejects go
    clean = C.drop_toxic(spark, docs, sf_dir)
    assert clean.columns == docs.columns
    kept = {r.doc_id: r for r in clean.collect()}
    model = toxicity.train(docs, labels)
    score = dict(zip(before, model.scores([r.text for r in before.values()]), strict=True))
    assert set(kept) == {d for d in before if score[d] < toxicity.THRESHOLD}
    assert len(kept) > 0.8 * len(before)
    # near copies: whatever goes is near one that stays, and none that stay are near
    first = {r.doc_id: r for r in C.drop_near_copies(spark, clean, sf_dir).collect()}
    sets = {d: shingles(r.text) for d, r in kept.items()}
    like = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    for d in set(kept) - set(first):
        assert max(like(d, x) for x in kept if x != d) >= 0.8 - 1e-9
    ids = sorted(first)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if not sets[a].isdisjoint(sets[b]):
                assert like(a, b) < 0.8
    # leaks
    frame = spark.createDataFrame([first[d] for d in ids], docs.schema)
    fold = lambda t: " ".join(t.lower().split())
    items = [fold(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    unleaked = {r.doc_id: r for r in C.drop_leaks(spark, frame, sf_dir).collect()}
    whole = {d for d in ids if any(i in fold(first[d].text) for i in items)}
    assert set(unleaked) <= set(ids) - whole and len(unleaked) > len(ids) - len(whole) - 3
    # personal data
    frame = spark.createDataFrame(list(unleaked.values()), docs.schema)
    redacted = C.redact_pii(spark, frame, sf_dir)
    assert redacted.columns == docs.columns
    after = {r.doc_id: r for r in redacted.collect()}
    assert set(after) == set(unleaked)
    for d, r in after.items():
        assert not any(re.search(p, r.text) for p in BASE)
        assert r.text == unleaked[d].text or "[" in r.text
    # packing
    check(C.pack_tokens(spark, redacted, sf_dir).collect(), [(d, r.text) for d, r in after.items()], 2048)


def test_run(spark, sf_dir):
    rows = C.run(spark, sf_dir).collect()
    assert rows and {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(rows[0].asDict())
    assert zlib.crc32(b"") == 0 and simhash.wide_radius(1.0) == 0


def test_stages_with_nulls_repeats_other_columns_and_without_rows(spark, sf_dir):
    """Every stage keeps the columns, whatever their names, and takes nulls, empty and repeated rows, long texts and empty tables."""
    kind = "doc_id long, text string, score string, _doc string, fp map<string,long>"
    long = "word after word " * 40_000
    rows = [(1, None, "a", None, None), (2, "", None, "b", {"x": 1}), (None, "no id", None, None, None), (None, "no id", None, None, None), (3, "twice the same text", None, None, None), (3, "twice the same text", None, None, None), (4, "twice the same text", "s", "d", None), (5, long, None, None, None), (6, "write to me@x.org", None, None, None)]
    docs = spark.createDataFrame(rows, kind)
    kept = {"toxicity": 9, "simhash_near_dedup": 7, "decontamination": 9, "pii": 9}
    for name, stage in C.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "best_fit_packing":
            assert out.columns == docs.columns, name
            got = out.collect()
            assert len(got) == kept[name], name
            assert {r.doc_id: r.fp for r in got}.get(2, {"x": 1}) == {"x": 1}
        else:
            check(out.collect(), [r[:2] for r in rows], 2048)
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name
