"""Click messages: reading them, checking them, and their Bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions.instants import instant
from mercato.functions.json_fields import maybe_falsy, parse_object, truthy

STREAM_SOURCE = "streaming/pubsub"
RAW_LIMIT = 10_000  # fixed value: characters of a bad message that the older design kept


def read_event_stream(spark: SparkSession, path: str | None = None,
                      kafka: dict[str, str] | None = None) -> DataFrame:
    """Unbounded messages with a ``value`` column: lines of files in a folder, or a Kafka topic."""
    if kafka is not None:
        return spark.readStream.format("kafka").options(**kafka).load()
    return spark.readStream.text(path)


def read_event_files(spark: SparkSession, path: str) -> DataFrame:
    """The same messages as a bounded read."""
    return spark.read.text(path)


def check_events(messages: DataFrame, value: str = "value", source: str = STREAM_SOURCE,
                 now=None, raw_limit: int | None = None) -> DataFrame:
    """Parse each message once and say what is wrong with it, if anything.

    Works on batch and streaming frames. ``error_type`` is NULL for valid rows.
    Messages are kept whole, so that any of them can be repaired and replayed;
    ``raw_limit`` (the older design's is RAW_LIMIT) keeps that many characters.
    """
    as_text = F.col(value).cast("string")
    whole = F.make_valid_utf8(as_text)
    text = messages.select(
        "*",
        F.try_validate_utf8(as_text).alias("_text"),
        (whole if raw_limit is None else F.substring(whole, 1, raw_limit)).alias("raw_message"),
    )
    parsed = parse_object(text, "_text", ["event_id", "event_type"], "_doc", maybe_falsy(F.col("_text")))
    both = truthy("_doc", "event_id") & truthy("_doc", "event_type")
    error = F.when(F.col("_doc").isNull(), "invalid_json").when(~both, "missing_required_fields")
    shown = [F.coalesce(F.col(f"_doc.{f}"), F.lit("None")) for f in ("event_id", "event_type")]
    detail = F.when(F.col("_doc").isNull(), F.lit("not one JSON object in valid UTF-8")).otherwise(
        F.concat(F.lit("event_id="), shown[0], F.lit(", event_type="), shown[1]))
    checked = parsed.select(
        *[c for c in messages.columns if c != value],
        F.col("_doc.event_id").alias("event_id"),
        F.col("_doc.event_type").alias("event_type"),
        F.trim(F.col("_text")).alias("raw_payload"),
        "raw_message",
        error.alias("error_type"),
        detail.alias("error_detail"),
        F.lit(source).alias("source"),
        instant(now).alias("ingested_at"),
    )
    return checked


def valid_events(checked: DataFrame) -> DataFrame:
    return checked.where("error_type is null").select(
        "event_id", "event_type", "raw_payload", "source", "ingested_at")


def event_errors(checked: DataFrame) -> DataFrame:
    return checked.where("error_type is not null").select(
        "raw_message", "error_type", "error_detail", "source",
        F.col("ingested_at").alias("error_timestamp"))


def split_events(messages: DataFrame, value: str = "value", source: str = STREAM_SOURCE,
                 now=None, raw_limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid Bronze rows, error rows)."""
    checked = check_events(messages, value, source, now, raw_limit)
    return valid_events(checked), event_errors(checked)


def replay_errors(errors: DataFrame, repair: Column | None = None, now=None) -> tuple[DataFrame, DataFrame]:
    """Send stored bad messages through the check again, optionally after a repair expression."""
    fixed = F.col("raw_message") if repair is None else repair
    return split_events(errors.select(fixed.alias("value")), now=now)


def strict_check(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages with the verdict of a full JSON decoder, for comparison runs."""
    import json

    def verdicts(frames):
        for frame in frames:
            out = []
            for text in frame[value]:
                try:
                    doc = json.loads(text)
                    keep = isinstance(doc, dict) and bool(doc.get("event_id")) and bool(doc.get("event_type"))
                    out.append("valid" if keep else
                               "missing_required_fields" if isinstance(doc, dict) else "invalid_json")
                except (TypeError, ValueError):
                    out.append("invalid_json")
            yield frame.assign(verdict=out)

    return messages.select(value).mapInPandas(verdicts, f"{value} string, verdict string")


def flatten(channels: dict[str, DataFrame]) -> DataFrame:
    """Union of several message sources, duplicates kept, each row tagged with its channel."""
    out = None
    for channel, df in channels.items():
        tagged = df.withColumn("channel", F.lit(channel))
        out = tagged if out is None else out.unionByName(tagged)
    return out
