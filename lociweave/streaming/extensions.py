"""Streaming forms of some operators; an extension, since all inputs of the field's tools are finite files.

State is bounded by watermarks: late rows beyond them are dropped by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling_counts(events: DataFrame, time: str, key: str, width: str, delay: str) -> DataFrame:
    """window start, key, n."""
    w = F.window(time, width)
    return events.withWatermark(time, delay).groupBy(w.alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")


def runs(events: DataFrame, time: str, key: str, gap: str, delay: str) -> DataFrame:
    """key, start, stop, n: events of a key with no gap longer than `gap` between them."""
    s = F.session_window(time, gap)
    return events.withWatermark(time, delay).groupBy(s.alias("s"), key).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("s.start").alias("start"), F.col("s.end").alias("stop"), "n")


def first_segments(events: DataFrame, time: str, key: list[str], delay: str) -> DataFrame:
    """The first row of each key within the watermark."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)
