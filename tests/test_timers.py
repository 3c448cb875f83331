import datetime as dt
import time

import pytest

from store_rows import rows
from mercato.lakehouse import Table
from mercato.operators import behaviour
from mercato.streaming import carts, jobs, outages

EVENTS = "event_id string, event_type string, session_id string, event_timestamp timestamp"
BEATS = "event_timestamp timestamp"
DAY = dt.datetime(2026, 3, 16, tzinfo=dt.timezone.utc)


def at(minute):
    return DAY + dt.timedelta(minutes=minute)


class Live:
    """A stream fed batch by batch; state and output go on from one run to the next."""

    def __init__(self, spark, home, make, schema=EVENTS):
        self.spark, self.home, self.make, self.schema = spark, home, make, schema
        self.frame = lambda: make(spark.readStream.schema(schema).parquet(f"{home}/in"))
        spark.createDataFrame([], schema).write.parquet(f"{home}/in")
        self.table = Table(spark, f"{home}/out", self.frame().schema).create()

    def feed(self, *events):
        self.spark.createDataFrame(list(events), self.schema).coalesce(1).write.mode("append").parquet(f"{self.home}/in")
        assert jobs.to_table(self.frame(), self.table, f"{self.home}/cp").awaitTermination(120)
        return self.table.read()


def step(kind, minute, session="s"):
    return (f"{kind}-{minute}", kind, session, at(minute))


def test_a_late_purchase_cancels_the_alarm(spark, tmp_path):
    live = Live(spark, str(tmp_path), lambda df: carts.cart_alarms(df, 1800))
    assert live.feed(step("add_to_cart", 0, "bought"), step("add_to_cart", 1, "left"), step("add_to_cart", 2, "left")).count() == 0
    # The watermark stands at minute 25: nothing is due.
    assert live.feed(step("purchase", 35, "clock")).count() == 0
    # Minute 29 comes after minute 35 did, but is not behind the watermark.
    assert live.feed(step("purchase", 29, "bought")).count() == 0
    got = live.feed(step("purchase", 42, "clock"))
    assert rows(got, "session_id", "cart_events") == [("left", 2)]
    assert rows(got.selectExpr("unix_timestamp(last_cart) - unix_timestamp(timestamp'2026-03-16') AS a",
                               "unix_timestamp(abandoned_at) - unix_timestamp(timestamp'2026-03-16') AS b")) == [(120, 1920)]
    assert live.feed(step("purchase", 500, "clock")).count() == 1, "an alarm goes off once"


def test_an_alarm_goes_off_at_its_very_instant(spark, tmp_path):
    live = Live(spark, str(tmp_path), lambda df: carts.cart_alarms(df, 1800))
    live.feed(step("add_to_cart", 0))
    assert live.feed(step("purchase", 39, "clock")).count() == 0
    assert live.feed(step("purchase", 40, "clock")).count() == 1


def test_order_of_arrival_does_not_matter(spark, tmp_path):
    kinds = ["add_to_cart", "page_view", "purchase", "add_to_cart", "add_to_cart", "search"]
    events = [(str(i), kinds[i * 7 % 6], None if i % 41 == 0 else f"s{i % 9}", None if i % 37 == 0 else at(i * 13 % 301))
              for i in range(300)] + [step("add_to_cart", 5, "tie"), step("purchase", 5, "tie")]
    live = Live(spark, str(tmp_path), lambda df: carts.cart_alarms(df, 240, lateness="6 hours"))
    for part in (events[:90], events[90:200], events[200:]):
        live.feed(*part)
    got = live.feed(step("purchase", 2000, "clock"))
    sound = spark.createDataFrame(events, EVENTS).where("session_id is not null and event_timestamp is not null")
    want = behaviour.abandoned_carts(sound, 240)
    assert rows(got) == rows(want) and want.count() > 10 and got.where("session_id = 'tie'").count() == 0


def test_one_hot_session_is_folded_before_the_shuffle(spark):
    import pandas as pd

    times = DAY.timestamp() * 1e6 + pd.Series(range(10_000)) * 1e6
    frame = pd.DataFrame({"key": ["hot"] * 9_999 + ["cold"], "at": times.astype("int64"), "cart": True})
    out = next(carts._folded(1_800_000_000)(iter([frame])))
    assert sorted(zip(out.key, out.cart_events)) == [("cold", 1), ("hot", 9_999)]
    assert len(next(carts._folded(1)(iter([frame.iloc[:0]])))) == 0


def test_sessions_share_states_and_stay_apart(spark, tmp_path):
    schema = EVENTS.replace("session_id string", "session_id long")
    live = Live(spark, str(tmp_path), lambda df: carts.cart_alarms(df, 1800), schema)
    n = 3 * carts.BUCKETS
    live.feed(*[(str(i), "add_to_cart", i, at(i % 7)) for i in range(n)])
    live.feed(*[(str(i), "purchase", i, at(8)) for i in range(0, n, 2)])
    spark.createDataFrame([("clock", "purchase", n, at(500))], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    last = jobs.to_table(live.frame(), live.table, f"{tmp_path}/cp")
    assert last.awaitTermination(120)
    assert max(p.stateOperators[0].numRowsTotal for p in last.recentProgress) <= carts.BUCKETS
    got = live.table.read()
    assert dict(got.dtypes)["session_id"] == "bigint"
    assert sorted(rows(got, "session_id", "cart_events")) == [(i, 1) for i in range(n) if i % 2]


def test_runs_reach_over_the_latest_end_so_far():
    import numpy as np

    runs = np.array([[0, 0, 100, 100, carts.NEVER, 2], [0, 10, 20, 20, carts.NEVER, 1], [0, 105, 105, carts.NEVER, 105, 0],
                     [0, 120, 120, 120, carts.NEVER, 1], [1, 121, 121, 121, carts.NEVER, 1]], np.int64)
    assert carts.joined_runs(runs, 10).tolist() == [
        [0, 0, 105, 100, 105, 3], [0, 120, 120, 120, carts.NEVER, 1], [1, 121, 121, 121, carts.NEVER, 1]]


def test_wall_clock_needs_no_further_event(spark, tmp_path):
    with pytest.raises(ValueError):
        carts.cart_alarms(spark.createDataFrame([], EVENTS), 60, clock="moon")
    now = dt.datetime.now(dt.timezone.utc)
    events = [("a", "add_to_cart", "soon", now), ("b", "add_to_cart", "much later", now + dt.timedelta(hours=1)),
              ("c", "add_to_cart", "paid", now), ("d", "purchase", "paid", now)]
    spark.createDataFrame(events, EVENTS).coalesce(1).write.parquet(f"{tmp_path}/in")
    alarms = carts.cart_alarms(spark.readStream.schema(EVENTS).parquet(f"{tmp_path}/in"), 8, clock="wall")
    table = Table(spark, f"{tmp_path}/out", alarms.schema).create()
    running = jobs.to_table(alarms, table, f"{tmp_path}/cp", every="1 second")
    try:
        end = time.monotonic() + 60
        while table.read().isEmpty() and time.monotonic() < end and running.isActive:
            time.sleep(1)
    finally:
        running.stop()
    assert rows(table.read(), "session_id") == [("soon",)]


def test_silence_is_reported_while_no_event_comes(spark, tmp_path):
    spark.createDataFrame([], BEATS).write.parquet(f"{tmp_path}/beats")

    def watch(events):
        beats = spark.readStream.schema(BEATS).parquet(f"{tmp_path}/beats")
        return outages.silent_windows(events, beats, ["purchase", "page_view"], 300, 2, "0 minutes")

    def tick(*minutes):
        spark.createDataFrame([(at(m),) for m in minutes], BEATS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/beats")

    live = Live(spark, str(tmp_path), watch)
    tick(0, 5)
    got = live.feed(step("purchase", 1), step("purchase", 6), step("page_view", 2), ("x", "page_view", "s", None))
    assert got.count() == 0
    tick(10, 15, 20)
    live.feed()
    at_minute = lambda: live.table.read().selectExpr("(unix_timestamp(window_start) - unix_timestamp(timestamp'2026-03-16')) DIV 60 AS m", "event_type", "event_count", "outage")
    assert rows(at_minute()) == [(10, "page_view", 0, True), (10, "purchase", 0, False), (15, "page_view", 0, True),
                               (15, "purchase", 0, True), (5, "page_view", 0, False)]
    tick(60, 65)  # nobody watched minutes 25 to 60
    live.feed()
    assert {r[0] for r in rows(at_minute())} == {5, 10, 15, 20, 60}


def test_heartbeats_tick_by_themselves(spark, tmp_path):
    beats = outages.heartbeats(spark, 5)
    assert beats.isStreaming and beats.columns == ["event_timestamp"]
