import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociweave.llm import sharding as S

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("slot", T.StringType()), T.StructField("cell", T.StringType())])


def check(rows, docs, shards=24):
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32) for r in rows) == sorted((-1 if d is None else d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs)
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards and r.law == "rows" and r.grown_shard is None
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    return Counter(r.shard == r.home_shard for r in rows)


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(S.op4_consistent_hash_sharding(spark, sf_dir).collect(), docs)


def test_limited_movement(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "string(id) as text")
    rows = S.shard(docs).collect()
    homes = check(rows, [(r, str(r)) for r in range(20_000)])
    assert homes[True] > 0.75 * len(rows)
    more = {r.doc_id: r.home_shard for r in S.shard(docs, 25).collect()}
    assert all(more[r.doc_id] in (r.home_shard, 24) for r in rows)


def test_cases(spark):
    docs = [(1, None), (2, ""), (3, "é"), (None, "x"), (None, "x")] + [(9, "same")] * 100
    check(S.shard(spark.createDataFrame([(*d, "s", "c") for d in docs], DOCS)).collect(), docs)
    assert S.shard(spark.createDataFrame([], DOCS)).count() == 0


def test_equal_rows_are_given_back_in_slices(spark, monkeypatch):
    monkeypatch.setattr(S, "REPEATS", 7)
    docs = [(None, None)] * 400 + [(5, "same")] * 400 + [(5, str(k)) for k in range(400)]
    check(S.shard(spark.createDataFrame([(*d, "s", "c") for d in docs], DOCS)).collect(), docs)


def test_against_a_plain_ring(spark):
    """Cell by cell clockwise, each row walks from its home to the first shard with room."""
    docs = spark.range(900).selectExpr("id % 300 as doc_id", "if(id % 7 = 0, null, string(id % 450)) as text")
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", F.octet_length(text).alias("size"), F.crc32(text.cast("binary")).alias("crc"))
    rows = keyed.withColumn("key", F.xxhash64("doc_id", "crc")).collect()
    cell = lambda r: (r.key % (1 << 64)) >> (64 - S.CELL_BITS)
    nodes, shards = S.ring(7), 7
    room = [len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    filled, want = [0] * shards, []
    for r in sorted(rows, key=lambda r: (cell(r), r.key, r.doc_id, r.crc, r.size)):
        k = next((k for k, (c, _) in enumerate(nodes) if c >= cell(r)), 0)
        while filled[s := nodes[k % len(nodes)][1]] == room[s]:
            k += 1
        want.append((r.doc_id, r.crc, s, filled[s]))
        filled[s] += 1
    assert sorted((r.doc_id, r.text_crc32, r.shard, r.slot) for r in S.shard(docs, 7).collect()) == sorted(want)
