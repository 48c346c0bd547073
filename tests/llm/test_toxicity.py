import random
import zlib

from pyspark.sql import types as T

from lociweave.llm import toxicity as X

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("toxic", T.IntegerType()), T.StructField("score", T.StringType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("toxic", T.IntegerType()), T.StructField("text", T.StringType())])


def corpus(n):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    docs, labels = [], []
    for k in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        toxic = k % 5 == 0
        if toxic:
            for _ in range(3):
                text[rng.randrange(len(text))] = rng.choice(["zorky", "zorkish", "wuxq"])
        docs.append((k, " ".join(text), None, "x"))
        labels.append((k, int(toxic), None))
    return docs, labels


def test_held_out_accuracy_and_cases(spark):
    docs, labels = corpus(600)
    extra = [(9001, None, 1, "y"), (9002, "", 0, "y"), (None, "zorky wuxq", None, None), (9003, "clean " * 50_000 + "zorky zorkish wuxq", None, None), (5, docs[5][1], 1, "x")]
    df = spark.createDataFrame(docs + extra, DOCS)
    lab = spark.createDataFrame([*labels, (None, 1, "t"), (3, None, "t"), (5, 0, None), (5, 1, None)], LABELS)
    rows = X.score(df, lab).collect()
    assert len(rows) == len(docs) + len(extra)
    by = {r.doc_id: r for r in rows}
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(by[d].score, t) for d, t, _ in labels if by[d].held_out]
    assert min(s for s, t in held if t) > max(s for s, t in held if not t)
    assert sum(by[d].predicted == t for d, t, _ in labels if by[d].held_out) >= 0.97 * len(held)
    assert by[9001].score == by[9002].score < 0.7 < by[9003].score
    kept = X.keep_clean(df, lab)
    assert kept.columns == df.columns and kept.count() == sum(r.predicted == 0 for r in rows)


def test_without_labels_or_rows(spark):
    docs, labels = corpus(20)
    df, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    assert {r.score for r in X.score(df, lab.limit(0)).collect()} == {0.0}
    assert X.score(df.limit(0), lab).count() == 0


def test_query(spark, sf_dir):
    rows = X.op7_toxicity(spark, sf_dir).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    clean = [r.predicted for r in rows if labels.get(r.doc_id) == 0]
    assert sum(clean) <= 0.02 * len(clean)


def test_a_doc_id_on_many_rows_is_learned_from_once(spark):
    docs, labels = corpus(300)
    df, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    more = df.union(spark.createDataFrame([(10, docs[10][1] + " and more", None, "x")] * 500, DOCS))
    one, two = X.train(df, lab), X.train(more, lab)
    assert one.features.tolist() == two.features.tolist() and abs(one.weights - two.weights).max() < 1e-6 and abs(one.bias - two.bias) < 1e-9
