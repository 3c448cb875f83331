"""Time windows, sessions, gaps and carts over events.

Ordered work per key is done on time slots, not on events: events are first
folded per key and slot, which Spark does before the shuffle. A visitor with most
of the events then costs one row per slot of the time range, whatever the count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.instants import bucket_start, ratio, seconds_between, time_bucket

FIVE_MINUTES = 300
HALF_HOUR = 1800
TS = "event_timestamp"


# ---- tumbling and sliding counts


def slot_counts(events: DataFrame, seconds: int = FIVE_MINUTES, ts: str = TS) -> DataFrame:
    """Events per slot and type; rows without a time are left out."""
    return events.where(F.col(ts).isNotNull()).groupBy(
        time_bucket(F.col(ts), seconds).alias("slot"), "event_type").agg(F.count("*").alias("event_count"))


def event_metrics_5min(events: DataFrame, seconds: int = FIVE_MINUTES, ts: str = TS) -> DataFrame:
    start = bucket_start(F.col("slot"), seconds)
    return slot_counts(events, seconds, ts).select(
        start.alias("window_start"), bucket_start(F.col("slot") + 1, seconds).alias("window_end"),
        "event_type", "event_count")


def sliding_event_counts(events: DataFrame, seconds: int = FIVE_MINUTES, every: int = 60,
                         ts: str = TS) -> DataFrame:
    """Counts in overlapping windows, built from the counts of their steps."""
    if seconds % every:
        raise ValueError("the window must be a whole number of steps")
    steps = slot_counts(events, every, ts)
    starts = F.sequence(F.col("slot") - (seconds // every - 1), F.col("slot"))
    return steps.select(F.explode(starts).alias("start"), "event_type", "event_count").groupBy(
        "start", "event_type").agg(F.sum("event_count").alias("event_count")).select(
        bucket_start(F.col("start"), every).alias("window_start"),
        F.timestamp_seconds(F.col("start") * every + seconds).alias("window_end"),
        "event_type", "event_count")


def silent_windows(events: DataFrame, types: Sequence[str], seconds: int = FIVE_MINUTES,
                   lookback: int = 3, ts: str = TS) -> DataFrame:
    """Slots in which a type had no event at all, zero rows included.

    ``outage`` marks those whose last ``lookback`` slots were all empty. The list
    of slots is spread by day before it is written out slot by slot.
    """
    counts = slot_counts(events.where(F.col("event_type").isin(*types)), seconds, ts)
    per_day = 86_400 // seconds
    span = events.agg(F.min(ts).alias("first"), F.max(ts).alias("last")).select(
        time_bucket(F.col("first"), seconds).alias("low"), time_bucket(F.col("last"), seconds).alias("high"))
    days = span.select("low", "high", F.explode(F.sequence(
        F.floor(F.col("low") / per_day), F.floor(F.col("high") / per_day))).alias("day"))
    slots = days.repartition("day").select(
        F.explode(F.sequence(F.greatest("low", F.col("day") * per_day),
                             F.least("high", (F.col("day") + 1) * per_day - 1))).alias("slot"))
    spine = slots.select("slot", F.explode(F.array(*[F.lit(t) for t in types])).alias("event_type"))
    offsets = F.explode(F.array(*[F.lit(i) for i in range(lookback)])).alias("offset")
    felt = counts.select("event_type", "slot", "event_count", offsets).groupBy(
        (F.col("slot") + F.col("offset")).alias("slot"), "event_type").agg(
        F.sum(F.when(F.col("offset") == 0, F.col("event_count")).otherwise(0)).alias("here"),
        F.sum("event_count").alias("lately"))
    return spine.join(felt, ["slot", "event_type"], "left").where(F.coalesce("here", F.lit(0)) == 0).select(
        bucket_start(F.col("slot"), seconds).alias("window_start"), "event_type",
        F.lit(0).cast("bigint").alias("event_count"),
        (F.coalesce("lately", F.lit(0)) == 0).alias("outage"))


def conversion_drop(events: DataFrame, seconds: int = FIVE_MINUTES, fall: float = 0.5, ts: str = TS) -> DataFrame:
    """Slots whose purchases per checkout fell by ``fall`` or more against the slot before.

    Each slot also speaks for the next one, so the comparison is one grouping
    and no ordering.
    """
    flows = events.where(F.col("event_type").isin("purchase", "checkout_start"))
    slots = slot_counts(flows, seconds, ts).select(
        "slot", "event_type", "event_count", F.explode(F.array(F.lit(0), F.lit(1))).alias("ahead"))

    def count(kind: str, ahead: int) -> Column:
        mine = (F.col("event_type") == kind) & (F.col("ahead") == ahead)
        return F.sum(F.when(mine, F.col("event_count")).otherwise(0))

    rates = slots.groupBy((F.col("slot") + F.col("ahead")).alias("slot")).agg(
        ratio(count("purchase", 0), count("checkout_start", 0)).alias("rate"),
        ratio(count("purchase", 1), count("checkout_start", 1)).alias("previous_rate"))
    return rates.where((F.col("previous_rate") > 0) & (F.col("rate") <= F.col("previous_rate") * (1 - fall))).select(
        bucket_start(F.col("slot"), seconds).alias("window_start"), "rate", "previous_rate")


# ---- sessions


def sessionize(events: DataFrame, keys: Sequence[str], gap: int, folds: dict[str, tuple[Column, str]],
               ts: str = TS) -> DataFrame:
    """Group each key's events into runs with no pause longer than ``gap`` seconds.

    ``folds`` maps an output to (aggregate over events, how parts combine: sum,
    min or max). Two events of one ``gap``-wide slot always share a run, so slots
    lose nothing. Adds ``started``, ``ended`` and ``run`` (numbered per key).
    """
    combine = {"sum": F.sum, "min": F.min, "max": F.max}
    slots = events.where(F.col(ts).isNotNull()).groupBy(*keys, time_bucket(F.col(ts), gap).alias("_slot")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"),
        *[part.alias(name) for name, (part, _) in folds.items()])
    order = Window.partitionBy(*keys).orderBy("_slot")
    pause = F.unix_micros("_first") - F.unix_micros(F.lag("_last").over(order))
    opens = F.coalesce((pause > gap * 1_000_000).cast("int"), F.lit(1))
    numbered = slots.withColumn("_opens", opens).withColumn(
        "run", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "run").agg(
        F.min("_first").alias("started"), F.max("_last").alias("ended"),
        *[combine[how](name).alias(name) for name, (_, how) in folds.items()])


def user_sessions(events: DataFrame, key: str = "customer_id", gap: int = HALF_HOUR, ts: str = TS) -> DataFrame:
    """Sessions per user; a session's window ends ``gap`` after its last event."""
    runs = sessionize(events, [key], gap, {"event_count": (F.count("*"), "sum")}, ts)
    return runs.select(key, F.col("started").alias("session_start"),
                       F.timestamp_micros(F.unix_micros("ended") + gap * 1_000_000).alias("session_end"),
                       "event_count")


def abandoned_carts(events: DataFrame, timeout: int, as_of: Column | None = None, key: str = "session_id",
                    ts: str = TS) -> DataFrame:
    """Carts with no purchase within ``timeout`` seconds of the last thing put in.

    Cart and purchase events less than ``timeout`` apart form one run; a run whose
    last cart event no purchase follows is abandoned. Runs still open at ``as_of``
    are left out.
    """
    at, kind = F.col(ts), F.col("event_type")
    steps = events.where(kind.isin("add_to_cart", "purchase"))
    runs = sessionize(steps, [key], timeout, {
        "last_cart": (F.max(F.when(kind == "add_to_cart", at)), "max"),
        "last_purchase": (F.max(F.when(kind == "purchase", at)), "max"),
        "cart_events": (F.count_if(kind == "add_to_cart"), "sum"),
    }, ts)
    left = runs.where(F.col("last_cart").isNotNull() & (
        F.col("last_purchase").isNull() | (F.col("last_purchase") < F.col("last_cart"))))
    out = left.select(key, "cart_events", "last_cart", F.timestamp_micros(
        F.unix_micros("ended") + timeout * 1_000_000).alias("abandoned_at"))
    return out if as_of is None else out.where(F.col("abandoned_at") <= as_of)


def event_gaps(events: DataFrame, seconds: int = FIVE_MINUTES, ts: str = TS) -> DataFrame:
    """Stretches of more than ``seconds`` without any event.

    Inside a slot no such stretch fits, so slots are compared: within a day first,
    then each day's first slot with the last event of an earlier day.
    """
    slots = events.where(F.col(ts).isNotNull()).groupBy(
        F.to_date(ts).alias("day"), time_bucket(F.col(ts), seconds).alias("slot")).agg(
        F.min(ts).alias("first"), F.max(ts).alias("last"))
    in_day = slots.withColumn("before", F.lag("last").over(Window.partitionBy("day").orderBy("slot")))
    # One row per calendar day reaches this unpartitioned window.
    days = slots.groupBy("day").agg(F.max("last").alias("day_last")).select(
        "day", F.lag("day_last").over(Window.orderBy("day")).alias("day_before"))
    joined = in_day.join(days, "day")
    before = F.coalesce("before", "day_before")
    silence = seconds_between(F.col("first"), before)
    return joined.where(silence > seconds).select(
        before.alias("gap_start"), F.col("first").alias("gap_end"), silence.alias("gap_seconds"))


def session_paths(events: DataFrame, key: str = "session_id", tiebreak: str = "event_id", ts: str = TS,
                  slot: int = FIVE_MINUTES) -> DataFrame:
    """Every event with its step number, the step before and the seconds since.

    Steps are numbered inside a slot; counts and last steps of the slots before
    are carried over from one row per key and slot.
    """
    timed = events.where(F.col(ts).isNotNull()).select(key, tiebreak, "event_type", ts).withColumn(
        "_slot", time_bucket(F.col(ts), slot))
    in_slot = Window.partitionBy(key, "_slot").orderBy(ts, tiebreak)
    rows = timed.select("*", F.row_number().over(in_slot).alias("_n"),
                        F.lag("event_type").over(in_slot).alias("_kind"), F.lag(ts).over(in_slot).alias("_at"))
    folded = timed.groupBy(key, "_slot").agg(
        F.count("*").alias("_count"), F.max(F.struct(ts, tiebreak, "event_type")).alias("_last"))
    by_slot = Window.partitionBy(key).orderBy("_slot")
    carried = folded.select(
        F.col(key).alias("_key"), F.col("_slot").alias("_of"),
        F.coalesce(F.sum("_count").over(by_slot.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_done"),
        F.lag("_last").over(by_slot).alias("_prior"))
    joined = rows.join(carried, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slot") == F.col("_of")))
    first = F.col("_n") == 1
    before = F.when(first, F.col("_prior")[ts]).otherwise(F.col("_at"))
    return joined.select(
        key, tiebreak, "event_type", ts,
        (F.col("_n") + F.col("_done")).alias("step"),
        F.when(first, F.col("_prior")["event_type"]).otherwise(F.col("_kind")).alias("previous_type"),
        seconds_between(F.col(ts), before).alias("seconds_since_previous"))
