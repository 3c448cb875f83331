"""Live outage watch: windows in which a kind of event did not happen at all.

A count alone never shows an empty window. Heartbeats (one row per tick and kind, weight 0) go into the same windows as the
events (weight 1), under one watermark on both: time passes with the heartbeats while the shop is silent, and a window whose
weights add up to nothing is reported as soon as it is final. One state, no join of streams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TS = "event_timestamp"


def heartbeats(spark: SparkSession, per_second: int = 1) -> DataFrame:
    """Ticks of the machine's clock."""
    return spark.readStream.format("rate").option("rowsPerSecond", per_second).load().select(F.col("timestamp").alias(TS))


def silent_windows(events: DataFrame, beats: DataFrame, types: Sequence[str], seconds: int = 300, lookback: int = 3,
                   lateness: str = "10 minutes") -> DataFrame:
    """(window_start, event_type, event_count = 0, outage) per final window and type without an event.

    ``outage``: the window and the ``lookback - 1`` before it are all empty. A window that holds neither a heartbeat nor an event
    is not reported: nothing watched it. Events behind the watermark and rows without a time are left out.
    Windows slide by their own length over ``lookback`` of them, so both counts come from one aggregation, partly done before
    the shuffle.
    """
    felt = events.where(F.col("event_type").isin(*types)).select(
        F.col(TS).cast("timestamp").alias(TS), "event_type", F.lit(1).alias("weight"))
    ticks = beats.select(F.col(TS).cast("timestamp").alias(TS), F.explode(F.array(*[F.lit(t) for t in types])).alias("event_type"),
                         F.lit(0).alias("weight"))
    span = F.window(TS, f"{seconds * lookback} seconds", f"{seconds} seconds")
    own = F.col(TS) >= F.col("w.end") - F.expr(f"interval {seconds} seconds")
    counted = felt.unionByName(ticks).where(F.col(TS).isNotNull()).withWatermark(TS, lateness).withColumn("w", span).groupBy(
        "w", "event_type").agg(F.sum(F.when(own, F.col("weight"))).alias("here"), F.sum("weight").alias("lately"))
    return counted.where("here = 0").select(  # null: nothing in the window itself, no heartbeat either
        (F.col("w.end") - F.expr(f"interval {seconds} seconds")).alias("window_start"), "event_type",
        F.col("here").alias("event_count"), (F.col("lately") == 0).alias("outage"))
