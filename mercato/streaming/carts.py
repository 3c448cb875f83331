"""Abandoned carts as a stateful job: a session's carts are kept until their own timer goes off.

State of a session is its open runs (cart and purchase events at most ``timeout`` apart), folded to five numbers each. Sessions
share BUCKETS states by the hash of their key, each with one timer for the run that is due first, so that Python is called
per bucket, on arrays, and not per session. A purchase within the timeout joins the run and so cancels the alarm, also if it
arrives late or before the cart event. Each Arrow batch is folded before the shuffle, so a session with a third of all
events sends a row per batch and run, not a row per event.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# The functions go to the executors by value, which then need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NEVER = -1 << 62
#: A run: microseconds of its first and last event, of its last cart and purchase events (NEVER: none), cart events.
RUN = ["started", "ended", "last_cart", "last_purchase", "cart_events"]
#: States that the open sessions share; checkpoints are bound to the number.
BUCKETS = 1024


def joined_runs(runs: np.ndarray, gap: int) -> np.ndarray:
    """Runs (rows in RUN's order, sorted by key and start; column 0 numbers the key) less than or just ``gap`` apart made one."""
    if not len(runs):
        return runs
    key, started, ended = runs[:, 0], runs[:, 1], runs[:, 2]
    other = np.concatenate([[True], key[1:] != key[:-1]])
    # The latest end so far within the key, as a running maximum of ranks that grow from key to key.
    by_end, rank = np.argsort(ended, kind="stable"), np.empty(len(runs), np.int64)
    rank[by_end] = np.arange(len(runs))
    base = np.cumsum(other) * len(runs)
    reach = ended[by_end[np.maximum.accumulate(base + rank) - base]]
    opens = other | np.concatenate([[True], started[1:] - reach[:-1] > gap])
    first = np.flatnonzero(opens)
    return np.column_stack([key[first], started[first], *[np.maximum.reduceat(runs[:, c], first) for c in (2, 3, 4)],
                            np.add.reduceat(runs[:, 5], first)])


def _folded(gap: int):
    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            number, names = pd.factorize(frame["key"])
            at, cart = frame["at"].to_numpy(), frame["cart"].to_numpy(bool)
            rows = np.column_stack([number, at, at, np.where(cart, at, NEVER), np.where(cart, NEVER, at), cart.astype(np.int64)])
            made = joined_runs(rows[np.lexsort((at, number))], gap)
            out = pd.DataFrame(made[:, 1:], columns=RUN)
            out.insert(0, "key", names.take(made[:, 0]))
            out["seen"] = pd.to_datetime(out["ended"], unit="us", utc=True)
            yield out

    return fold


def _alarm(gap: int, wall: bool):
    def run(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept, *old = state.get if state.exists else ([], *[[] for _ in RUN])
        parts, keys = [np.array(old, np.int64).T], list(kept)
        for frame in frames:
            parts.append(frame[RUN].to_numpy(np.int64))
            keys.extend(frame["key"])
        runs = np.vstack(parts)
        number, names = pd.factorize(np.array(keys, object))
        known = joined_runs(np.column_stack([number, runs])[np.lexsort((runs[:, 0], number))], gap)
        now = state.getCurrentProcessingTimeMs() if wall else state.getCurrentWatermarkMs()
        due = known[:, 2] + gap
        over = due <= now * 1000
        left = known[over & (known[:, 3] > known[:, 4])]
        if over.all():
            state.remove()
        else:
            wait = known[~over]
            state.update((names[wait[:, 0]].tolist(), *[c.tolist() for c in wait[:, 1:].T]))
            first = -(-int(due[~over].min()) // 1000)
            if wall:
                state.setTimeoutDuration(max(first - now, 1))
            else:
                state.setTimeoutTimestamp(max(first - 1, now))  # it goes off once the watermark is past this
        if len(left):
            yield pd.DataFrame({"key": names[left[:, 0]], "cart_events": left[:, 5],
                                "last_cart": pd.to_datetime(left[:, 3], unit="us", utc=True),
                                "abandoned_at": pd.to_datetime(left[:, 2] + gap, unit="us", utc=True)})

    return run


def cart_alarms(events: DataFrame, timeout: int, key: str = "session_id", lateness: str = "10 minutes",
                clock: str = "event") -> DataFrame:
    """(key, cart_events, last_cart, abandoned_at) of carts that no purchase followed within ``timeout`` seconds, once each.

    ``clock="event"`` fires when the watermark reaches the timeout and drops later events, so the rows are those of the batch
    form (``behaviour.abandoned_carts``) that are due by the watermark, whatever order events arrive in. ``clock="wall"``
    fires by the machine's clock, with no further event needed, in jobs that keep running (``every``); an event that comes in
    after that starts a new run.
    Events without a key or a time are left out; a purchase at the instant of the last cart event closes the cart.
    """
    if clock not in ("event", "wall"):
        raise ValueError(f"clock is 'event' or 'wall', not {clock!r}")
    kind, at, gap = F.col("event_type"), F.col("event_timestamp"), timeout * 1_000_000
    steps = events.where(kind.isin("add_to_cart", "purchase") & F.col(key).isNotNull() & at.isNotNull()).select(
        F.col(key).cast("string").alias("key"), F.unix_micros(at.cast("timestamp")).alias("at"), (kind == "add_to_cart").alias("cart"))
    runs = steps.mapInPandas(_folded(gap), f"key string, {', '.join(f'{c} long' for c in RUN)}, seen timestamp")
    if clock == "event":
        runs = runs.withWatermark("seen", lateness)
    shared = runs.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)))
    alarms = shared.groupBy("bucket").applyInPandasWithState(
        _alarm(gap, clock == "wall"), "key string, cart_events long, last_cart timestamp, abandoned_at timestamp",
        f"keys array<string>, {', '.join(f'{c} array<long>' for c in RUN)}", "append",
        GroupStateTimeout.ProcessingTimeTimeout if clock == "wall" else GroupStateTimeout.EventTimeTimeout)
    return alarms.select(F.col("key").cast(events.schema[key].dataType).alias(key), *alarms.columns[1:])
