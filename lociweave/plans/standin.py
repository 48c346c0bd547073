"""The driver's tables seen as members, hits, features, intervals and sequences; SQL gives the same views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


MEMBERS = """members AS (SELECT DISTINCT l_partkey AS cluster, c_nationkey AS genome FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey WHERE l_quantity <= p_size)"""


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cluster = part, genome = nation of the customer."""
    t = lambda n: table(spark, sf_dir, n)
    li = t("lineitem").select("l_orderkey", "l_partkey", "l_quantity").join(t("part").select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey")).where("l_quantity <= p_size")
    o = t("orders").select("o_orderkey", "o_custkey").join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_partkey").alias("cluster"), F.col("c_nationkey").alias("genome")).distinct()


REGIONS = """regions AS (SELECT DISTINCT cluster, n_regionkey AS genome FROM members JOIN nation ON genome = n_nationkey)"""


def region_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the five regions as genomes."""
    n = F.broadcast(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("genome"), "n_regionkey"))
    return members(spark, sf_dir).join(n, "genome").select("cluster", F.col("n_regionkey").alias("genome")).distinct()


HITS = """hits AS (SELECT l_partkey AS qid, l_suppkey AS sid, l_partkey % 25 AS qgenome, l_suppkey % 25 AS sgenome, 50 + l_quantity AS pid, l_extendedprice AS bits,
 l_discount * 1e-4 AS evalue, CAST(l_quantity AS INTEGER) AS len FROM lineitem)"""


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hit table: query = part, subject = supplier, both ids of features; genome = id modulo 25."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").alias("qid"),
        F.col("l_suppkey").alias("sid"),
        (F.col("l_partkey") % 25).alias("qgenome"),
        (F.col("l_suppkey") % 25).alias("sgenome"),
        (F.lit(50) + F.col("l_quantity")).alias("pid"),
        F.col("l_extendedprice").alias("bits"),
        (F.col("l_discount") * F.lit(1e-4)).alias("evalue"),
        F.col("l_quantity").cast("int").alias("len"),
    )


FEATURES = """features AS (SELECT event_id AS feat, user_id AS contig, event_type || '_' || CAST(event_id % 40 AS VARCHAR) AS cluster, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos,
 CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END AS orient, user_id % 10 AS genome FROM events)"""


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered features: contig = user, cluster = event type; genome = user modulo 10, strand from the id."""
    from ..operators.order import positions

    e = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("feat"),
        F.col("user_id").alias("contig"),
        F.concat("event_type", F.lit("_"), (F.col("event_id") % 40).cast("string")).alias("cluster"),
        "ts",
        F.when(F.col("event_id") % 2 == 0, 1).otherwise(-1).alias("orient"),
        (F.col("user_id") % 10).alias("genome"),
    )
    return positions(e, ["contig"], ["ts", "feat"])


INTERVALS = """days AS (SELECT o_custkey AS contig, date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS d1, date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS d2, l_returnflag AS kind, l_partkey AS part
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey), intervals AS (SELECT contig, least(d1, d2) AS start, greatest(d1, d2) AS stop, kind, contig * 100000000 + least(d1, d2) * 10000 + greatest(d1, d2) AS name, part FROM days)"""


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """contig = customer; the days between order and shipping are the interval."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_returnflag", "l_partkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    day = lambda c: F.datediff(F.col(c), F.lit("1990-01-01").cast("date"))
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(
        F.col("o_custkey").alias("contig"),
        F.least(day("o_orderdate"), day("l_shipdate")).alias("start"),
        F.greatest(day("o_orderdate"), day("l_shipdate")).alias("stop"),
        F.col("l_returnflag").alias("kind"),
        F.col("l_partkey").alias("part"),
    ).withColumn("name", F.col("contig") * 100000000 + F.col("start") * 10000 + F.col("stop"))


SEQUENCES = """sequences AS (SELECT doc_id AS id, lang AS genome, upper(regexp_replace(text, '[^acgtACGT]', '', 'g')) AS seq FROM documents)"""


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The letters A, C, G and T of each document as its sequence; genome = language."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("id"), F.col("lang").alias("genome"), F.upper(F.regexp_replace("text", "[^acgtACGT]", "")).alias("seq"))
