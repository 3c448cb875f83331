"""Structured Streaming jobs.

Sinks are ``foreachBatch`` writes to lakehouse tables that remember the batch
number, so a batch that is run again after a failure is not written twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mercato.functions.instants import instant
from mercato.lakehouse import Lakehouse, Table
from mercato.operators.ingest import append_bronze
from mercato.operators.merge import parse_bronze
from mercato.operators.privacy import protect_message, protect_payload
from mercato.plans.gold import funnel
from mercato.schemas import ENTITIES
from mercato.sources.csv_files import PATH, csv_columns, relative_path, stream_entity_csv, to_bronze
from mercato.sources.messages import check_events, event_errors, valid_events

LATENESS = "10 minutes"


def start(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
          every: str | None = None) -> StreamingQuery:
    """Run ``write`` per micro-batch; without ``every`` take what is there and stop."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (stream.writeStream.foreachBatch(write).outputMode(mode)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def to_table(stream: DataFrame, table: Table, checkpoint: str, mode: str = "append",
             every: str | None = None) -> StreamingQuery:
    """Append to an existing table, each micro-batch exactly once."""
    table.state()
    return start(stream, lambda df, n: table.append(df, (checkpoint, n)) and None, checkpoint, mode, every)


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt out evenly over the session's shuffle partitions, or its cores if those are more.

    For work of a millisecond's order a row: a file of a few MB is one task otherwise, however many rows it has.
    """
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def events_to_bronze(lake: Lakehouse, messages: DataFrame, checkpoint: str, errors: bool = True,
                     dedupe: str | None = None, policy: Mapping[str, str] | None = None, key: str | None = None,
                     now=None, every: str | None = None) -> StreamingQuery:
    """Messages to ``events_raw``, and bad ones to ``events_errors`` if asked.

    ``dedupe`` (a time span) drops what is delivered again within it: valid
    messages by event id, bad ones by their text.
    ``policy`` protects personal fields of the payload on the way, at any depth. Bad messages then become tokens
    of the whole text (``pii.detokenize`` opens them for a replay) or, without a key, are protected by pattern; their
    ``error_detail``, which quotes them, is NULL.
    """
    good, bad = lake.bronze("events_raw"), lake.bronze("events_errors")
    good.state()
    checked = check_events(spread(messages) if policy else messages, now=now)
    if policy:
        failed = F.col("error_type").isNotNull()
        checked = checked.withColumns({
            "raw_payload": F.when(~failed, protect_payload(F.col("raw_payload"), policy, key)),
            "raw_message": F.when(failed, protect_message(F.col("raw_message"), policy, key)),
            "error_detail": F.when(failed, F.lit(None).cast("string"))})
    if dedupe:
        same = F.when(F.col("error_type").isNull(), F.concat(F.lit("id:"), F.col("event_id"))).otherwise(
            F.sha2("raw_message", 256))
        checked = checked.withColumn("_same", same).withWatermark(
            "ingested_at", dedupe).dropDuplicatesWithinWatermark(["_same"])

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            append_bronze(good, valid_events(batch), (checkpoint, number))
            if errors:
                bad.append(event_errors(batch), (checkpoint, number))
        finally:
            batch.unpersist()

    return start(checked, write, checkpoint, every=every)


def csv_to_bronze(lake: Lakehouse, landing: str, entity: str, checkpoint: str, now=None,
                  every: str | None = None) -> StreamingQuery:
    """Each new file of an entity's folder becomes Bronze rows, once."""
    spec = ENTITIES[entity]
    rows = stream_entity_csv(lake.spark, f"{landing.rstrip('/')}/{entity}", csv_columns(spec))
    source = F.concat(F.lit("gcs/"), relative_path(F.col(PATH), landing))
    table = lake.bronze(spec.bronze_table)
    return to_table(to_bronze(rows, entity, source, now).where(F.col(table.schema[0].name).isNotNull()),
                    table, checkpoint, every=every)


def raw_append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Messages to files as they are."""
    return (stream.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def typed_events(bronze_events: DataFrame) -> DataFrame:
    """Silver-shaped events; an event without a readable time gets its arrival time."""
    spec = ENTITIES["events"]
    typed = parse_bronze(bronze_events, spec, lineage=True)
    return typed.withColumn("event_timestamp", F.coalesce("event_timestamp", "_ingested_at")).select(
        *spec.columns, "processed_at")


def window_counts(events: DataFrame, size: str = "5 minutes", slide: str | None = None,
                  lateness: str = LATENESS) -> DataFrame:
    """Events per window and type; windows are final once the watermark passes them."""
    window = F.window("event_timestamp", size, slide) if slide else F.window("event_timestamp", size)
    counted = events.withWatermark("event_timestamp", lateness).groupBy(window.alias("w"), "event_type").agg(
        F.count("*").alias("event_count"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                          "event_type", "event_count")


def event_metrics_to_silver(lake: Lakehouse, events: DataFrame, checkpoint: str, now=None,
                            lateness: str = LATENESS) -> StreamingQuery:
    counted = window_counts(events, lateness=lateness)
    table = lake.silver("event_metrics_5min")
    table.state()

    def write(batch: DataFrame, number: int) -> None:
        table.append(batch.withColumn("calculated_at", instant(now)), (checkpoint, number))

    return start(counted, write, checkpoint)


def user_sessions(events: DataFrame, gap: str = "30 minutes", key: str = "customer_id",
                  lateness: str = LATENESS) -> DataFrame:
    session = F.session_window("event_timestamp", gap)
    return events.withWatermark("event_timestamp", lateness).groupBy(session.alias("w"), key).agg(
        F.count("*").alias("event_count")).select(
        key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "event_count")


def abandoned_carts(events: DataFrame, timeout: str, key: str = "session_id", lateness: str = LATENESS) -> DataFrame:
    """Carts whose last item no purchase followed within ``timeout``; emitted when that is certain."""
    kind, at = F.col("event_type"), F.col("event_timestamp")
    steps = events.where(kind.isin("add_to_cart", "purchase")).withWatermark("event_timestamp", lateness)
    runs = steps.groupBy(F.session_window("event_timestamp", timeout).alias("w"), key).agg(
        F.max(F.when(kind == "add_to_cart", at)).alias("last_cart"),
        F.max(F.when(kind == "purchase", at)).alias("last_purchase"),
        F.count_if(kind == "add_to_cart").alias("cart_events"))
    open_cart = F.col("last_purchase").isNull() | (F.col("last_purchase") < F.col("last_cart"))
    return runs.where(F.col("last_cart").isNotNull() & open_cart).select(
        key, "cart_events", "last_cart", F.col("w.end").alias("abandoned_at"))


def live_funnel(events: DataFrame, size: str = "5 minutes", lateness: str = LATENESS) -> DataFrame:
    """Funnel counts and rates per window."""
    stages = funnel(events.withWatermark("event_timestamp", lateness).groupBy(
        F.window("event_timestamp", size).alias("w")))
    return stages.select(F.col("w.start").alias("window_start"), *stages.columns[1:])
