"""Operator 4: consistent-hash sharding with virtual nodes and bounded loads (native).

The ring has CELLS cells; a row's key (doc_id and checksum) hashes to a cell, and every shard
owns virtual nodes on the ring. A row belongs to the shard of the first virtual
node at or after its cell. A shard holds at most its bound, here an equal share of all rows; rows
that find it full continue clockwise to the next shard with room. So counts differ
by one at most (law `rows`), and only the overflow leaves its home shard.

Spark counts the rows of each cell (at most CELLS counts reach the driver, however
large the table). From these the bound is worked out: each cell's rows, in the order of their hash,
fall into runs that go to one shard each, with their first slot there. Rows that are equal in doc_id, size
and checksum are counted first, in a table that is read again for the ranks; a window per cell gives each of these groups its range of ranks, and a
broadcast join with the runs (at most CELLS + shards x vnodes rows) cuts the ranges by
shard and gives the rows back, REPEATS at a time. So neither shards nor equal rows are gathered in one task.

Input cases: null text: size 8, checksum 0; the key has the text's checksum besides doc_id, so that rows of one
doc_id, or of none, spread over the ring; rows equal in all of doc_id, size and checksum take
neighbouring ranks and are interchangeable; rows of equal texts but different doc_id are rows of their own and spread
over the ring; empty table: empty result; other columns are ignored.

The bound leaves no slack, as the law `rows` asks, so it is the overflow that a new row or shard moves: with 24
shards a quarter of the rows or less lives away from its home. grown_shard is null under this law.
"""

from __future__ import annotations

import json

import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

CELL_BITS = 12
CELLS = 1 << CELL_BITS
VNODES = 32
REPEATS = 65_536


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise."""
    nodes = ((xxhash.xxh64_intdigest(f"shard {s} node {v}"), s) for s in range(shards) for v in range(vnodes))
    return [(h >> (64 - CELL_BITS), s) for h, s in sorted(nodes)]


def allocate(counts: dict[int, int], shards: int, vnodes: int = VNODES) -> list[dict]:
    """Runs of ranks in each cell with the shard that takes them, its first slot for them, and the home shard."""
    nodes = ring(shards, vnodes)
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled = [0] * shards
    runs, k = [], 0
    for cell in range(CELLS):
        while k < len(nodes) and nodes[k][0] < cell:
            k += 1
        left, at, step = counts.get(cell, 0), 0, 0
        home = nodes[k % len(nodes)][1]
        while left:
            s = nodes[(k + step) % len(nodes)][1]
            step += 1
            if n := min(left, room[s]):
                runs.append({"cell": cell, "first": at, "last": at + n - 1, "shard": s, "slot0": filled[s], "home_shard": home})
                at, left = at + n, left - n
                room[s] -= n
                filled[s] += n
    return runs


def shard(docs: DataFrame, shards: int = 24, vnodes: int = VNODES) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, home_shard for each row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    key = F.xxhash64("doc_id", "text_crc32")
    cell = F.shiftrightunsigned(key, 64 - CELL_BITS).cast("int")
    equal = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    equal = stored(equal.withColumns({"cell": cell, "key": key}))
    counts = {r["cell"]: r["n"] for r in equal.groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    kind = "array<struct<cell:int,first:long,last:long,shard:int,slot0:long,home_shard:int>>"
    runs = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(allocate(counts, shards, vnodes))), kind)))
    up_to = Window.partitionBy("cell").orderBy("key", "doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, 0)
    ranked = equal.withColumn("end", F.sum("n").over(up_to)).withColumn("begin", F.col("end") - F.col("n"))
    parts = ranked.join(F.broadcast(runs), "cell").where("begin <= last and first < end")
    parts = parts.withColumns({"low": F.greatest("begin", "first"), "high": F.least(F.col("end") - 1, "last")})
    parts = parts.withColumn("at", F.explode(F.sequence("low", "high", F.lit(REPEATS).cast("long"))))
    placed = parts.withColumn("rank", F.explode(F.sequence("at", F.least(F.col("at") + (REPEATS - 1), "high"))))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("slot0") + F.col("rank") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "home_shard",
    )


def op4_consistent_hash_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
