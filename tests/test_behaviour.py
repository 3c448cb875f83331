import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from store_rows import rows
from mercato.operators import behaviour as b

START = datetime(2026, 1, 1)
KINDS = ["page_view", "add_to_cart", "purchase", "checkout_start"]


def frame(spark, events):
    """events: (id, kind, session, seconds since START)"""
    data = [(i, k, s, str(START + timedelta(seconds=t)) if t is not None else None) for i, k, s, t in events]
    return spark.createDataFrame(data, "event_id int, event_type string, session_id string, at string").select(
        "event_id", "event_type", "session_id", F.col("session_id").alias("customer_id"),
        F.col("at").cast("timestamp").alias("event_timestamp"))


def seconds(column):
    return (F.unix_micros(column) - F.unix_micros(F.lit(str(START)).cast("timestamp"))) / 1_000_000


@pytest.fixture(scope="module")
def busy(spark):
    """Mostly one session, with pauses around every limit, over three days with an empty one between."""
    rng, out, t = random.Random(7), [], 0
    for i in range(400):
        t += rng.choice([0, 1, 59, 60, 61, 299, 300, 301, 1799, 1800, 1801, 7000])
        if i == 200:
            t += 2 * 86_400
        out.append((i, rng.choice(KINDS), rng.choice(["hot", "hot", "hot", "b", None]), t))
    return out


def brute_runs(events, gap):
    found, last = {}, {}
    for i, kind, s, t in sorted(events, key=lambda e: (e[3], e[0])):
        if s not in last or t - last[s] > gap:
            found.setdefault(s, []).append([])
        found[s][-1].append((t, kind))
        last[s] = t
    return found


def test_sessions(spark, busy):
    got = rows(b.user_sessions(frame(spark, busy)).select(
        "customer_id", seconds("session_start").cast("int"), seconds("session_end").cast("int"), "event_count"))
    want = [(s, r[0][0], r[-1][0] + 1800, len(r)) for s, rs in brute_runs(busy, 1800).items() for r in rs]
    assert got == sorted(want, key=repr)


def test_exactly_thirty_minutes_is_one_session(spark):
    apart = lambda gap: b.user_sessions(frame(spark, [(1, "v", "u", 100), (2, "v", "u", 100 + gap)])).count()
    assert apart(1800) == 1 and apart(1801) == 2


def test_carts(spark, busy):
    steps = [e for e in busy if e[1] in ("add_to_cart", "purchase")]
    want = []
    for s, rs in brute_runs(steps, 600).items():
        for r in rs:
            carts = [t for t, k in r if k == "add_to_cart"]
            buys = [t for t, k in r if k == "purchase"]
            if carts and (not buys or max(buys) < max(carts)):
                want.append((s, len(carts), carts[-1], r[-1][0] + 600))
    got = rows(b.abandoned_carts(frame(spark, busy), 600).select(
        "session_id", "cart_events", seconds("last_cart").cast("int"), seconds("abandoned_at").cast("int")))
    assert got == sorted(want, key=repr)


def test_gaps_across_days(spark, busy):
    times = sorted(t for *_, t in busy)
    want = sorted((float(y - x),) for x, y in zip(times, times[1:]) if y - x > 300)
    assert sorted(rows(b.event_gaps(frame(spark, busy)), "gap_seconds")) == want


def test_paths(spark, busy):
    want, seen = [], {}
    for i, kind, s, t in sorted(busy, key=lambda e: (e[3], e[0])):
        step, before, at = seen.get(s, (0, None, None))
        want.append((s, i, step + 1, before, None if at is None else float(t - at)))
        seen[s] = (step + 1, kind, t)
    got = rows(b.session_paths(frame(spark, busy)), "session_id", "event_id", "step", "previous_type",
               "seconds_since_previous")
    assert got == sorted(want, key=repr)


def test_counts_add_up_and_null_times_are_left_out(spark, busy):
    df = frame(spark, busy + [(999, "page_view", "x", None)])
    assert b.event_metrics_5min(df).agg(F.sum("event_count")).first()[0] == len(busy)
    assert b.sliding_event_counts(df).agg(F.sum("event_count")).first()[0] == 5 * len(busy)
    with pytest.raises(ValueError):
        b.sliding_event_counts(df, 300, 70)


def test_silence(spark):
    df = frame(spark, [(1, "purchase", "s", 10), (2, "page_view", "s", 86_400), (3, "purchase", "s", 86_410)])
    got = b.silent_windows(df, ["purchase", "page_view"])
    assert got.where("event_type = 'purchase'").count() == 287
    quiet = got.where("event_type = 'purchase' and not outage").select(
        (seconds("window_start") / 300).cast("int").alias("slot"))
    assert rows(quiet) == [(1,), (2,)]
    assert got.where("event_type = 'page_view' and outage").count() == 288


def test_conversion_drop(spark):
    kinds = [("checkout_start", 0), ("purchase", 1), ("checkout_start", 300), ("checkout_start", 301),
             ("purchase", 302), ("checkout_start", 600), ("checkout_start", 900)]
    df = frame(spark, [(i, k, "s", t) for i, (k, t) in enumerate(kinds)])
    assert rows(b.conversion_drop(df), "rate", "previous_rate") == [(0.0, 0.5), (0.5, 1.0)]
