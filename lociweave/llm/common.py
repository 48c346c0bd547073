"""Helpers that several training-data operators share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one is made only in local mode where none is set."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Write to a table in the shared folder and read it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete what stored() wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


Batches = Iterator[pa.RecordBatch]


def tidy(f: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """f, for mapInArrow, giving freed memory back to the system at its end: Python workers live on from stage to stage."""

    def run(batches: Batches) -> Batches:
        yield from f(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return run


#: Keys with more than one in so many rows count as popular; there are fewer of them than this.
HOT_KEYS = 256


def join_counted(rows: DataFrame, keyed: DataFrame, key: list[str], total: int, n: str) -> DataFrame:
    """rows joined with keyed, which has one row a key and in n how many of the `total` rows hold it; without n.

    Popular keys, fewer than HOT_KEYS by their definition, are broadcast; rows of all others
    are shuffled by key. So no task gathers the rows of one popular key.
    """
    popular = F.col(n) * HOT_KEYS > total
    hot = keyed.where(popular).drop(n)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(keyed.where(~popular).drop(n), key)
    return rows.join(F.broadcast(hot), key).unionByName(rest)


def join_salted(rows: DataFrame, keyed: DataFrame, key: str, how: str = "inner", by: list[str] | None = None) -> DataFrame:
    """rows joined with keyed, whose rows are wide; a key with more than one in HOT_KEYS of rows meets that many copies of keyed's row for it.

    by: the columns of rows that deal them to the copies, all others if not given. Only the popular keys, fewer than HOT_KEYS, are broadcast, never keyed's columns.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    share = F.ceil(F.col("_n") * HOT_KEYS / F.lit(max(1, rows.count())))
    popular = F.broadcast(counts.select(key, share.cast("int").alias("_copies")).where("_copies > 1"))
    copies = F.coalesce("_copies", F.lit(1))
    others = by or [c for c in rows.columns if c != key]
    salted = rows.join(popular, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*others), copies).cast("int")).drop("_copies")
    copied = keyed.join(popular, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1))).drop("_copies")
    return salted.join(copied, [key, "_salt"], how).drop("_salt")


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node reachable.

    Alternates the two star operations: every node's larger neighbours, then its
    smaller ones, are tied to the smallest neighbour. Each round is two
    aggregations and two joins of edges with per-node minima (those of hubs are broadcast, so no
    task gathers a hub's edges), written to the shared folder. It ends when a round changes nothing. Nulls and loops are dropped.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = stored(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    total = e.count()
    seen = None
    for _ in range(max_rounds):
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = join_counted(both.where("v > u"), low, ["u"], 2 * total, "n").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = join_counted(large, low, ["u"], total, "n").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        small = small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct()
        new = stored(small)
        now = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        total = now[0]
        drop_stored(e)
        e = new
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
