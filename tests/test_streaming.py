import json

import pytest
from pyspark.sql import functions as F

from store_rows import rows
from mercato.lakehouse import Lakehouse, Table, TableMissing
from mercato.operators import behaviour
from mercato.operators.merge import merge_into
from mercato.schemas import ENTITIES
from mercato.sources import csv_files, messages
from mercato.streaming import jobs

def click(number, kind, at, **more):
    return {"event_id": f"click-{number}", "event_type": kind, "customer_id": "shopper-7", "session_id": "visit-42",
            "product_id": None, "page_url": "/sale", "device": "tablet", "timestamp": at} | more


CLICKS = [click(0, "page_view", "2025-09-03T08:15:02Z"), click(1, "product_view", "2025-09-03T08:16:40Z"),
          click(2, "add_to_cart", "2025-09-03T08:17:11Z"), click(3, "purchase", "2025-09-03T08:18:59Z")]


def send(folder, name, docs):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in docs) + "\n")


def late(t):
    return {"event_id": "sentinel", "event_type": "search", "timestamp": t}


def run(query):
    assert query.awaitTermination(120)


def test_events_to_bronze_and_errors(spark, lake, tmp_path):
    inbox, cp = tmp_path / "in", str(tmp_path / "cp")
    send(inbox, "a.json", [*CLICKS, "not json", {"some_field": "some_value"}])
    go = lambda: run(jobs.events_to_bronze(lake, messages.read_event_stream(spark, str(inbox)), cp))
    go()
    assert rows(lake.bronze("events_raw").read(), "event_id", "source") == [
        (f"click-{i}", "streaming/pubsub") for i in range(4)]
    assert rows(lake.bronze("events_errors").read(), "raw_message", "error_type") == [
        ("not json", "invalid_json"), ('{"some_field": "some_value"}', "missing_required_fields")]
    send(inbox, "b.json", [CLICKS[0] | {"event_id": "click-9"}])
    go(), go()
    assert lake.bronze("events_raw").read().count() == 5
    batch, _ = messages.split_events(messages.read_event_files(spark, str(inbox)))
    assert rows(batch, "event_id", "raw_payload") == rows(lake.bronze("events_raw").read(), "event_id", "raw_payload")


def test_a_batch_run_again_is_not_written_again(spark, lake):
    good = spark.createDataFrame([("e", "t", "{}", "s")], "event_id string, event_type string, raw_payload string, source string"
                                 ).withColumn("ingested_at", F.lit("2026-01-01").cast("timestamp"))
    for _ in range(2):
        lake.bronze("events_raw").append(good, ("cp", 3))
    assert lake.bronze("events_raw").read().count() == 1


def test_missing_target_is_an_error(spark, tmp_path):
    bare = Lakehouse(spark, str(tmp_path / "none"))
    send(tmp_path / "in", "a.json", CLICKS)
    with pytest.raises(TableMissing):
        jobs.events_to_bronze(bare, messages.read_event_stream(spark, str(tmp_path / "in")), str(tmp_path / "cp"))


def test_repeated_ids_are_dropped(spark, lake, tmp_path):
    send(tmp_path / "in", "a.json", [*CLICKS, "bad", "worse", *CLICKS, "bad"])
    run(jobs.events_to_bronze(lake, messages.read_event_stream(spark, str(tmp_path / "in")), str(tmp_path / "cp"),
                              dedupe="1 hour"))
    assert lake.bronze("events_raw").read().count() == 4
    assert rows(lake.bronze("events_errors").read(), "raw_message") == [("bad",), ("worse",)]


def test_payload_is_protected_on_the_way(spark, lake, tmp_path):
    send(tmp_path / "in", "a.json", [CLICKS[0] | {"email": "maria@example.com"}])
    run(jobs.events_to_bronze(lake, messages.read_event_stream(spark, str(tmp_path / "in")), str(tmp_path / "cp"),
                              policy={"email": "mask_email"}))
    doc = json.loads(lake.bronze("events_raw").read().first().raw_payload)
    assert doc["email"] == "m****@*******.com" and doc["event_id"] == "click-0" and doc["product_id"] is None


def test_protection_of_one_file_is_dealt_over_tasks(spark, lake, tmp_path, monkeypatch):
    tasks, start = [], jobs.start

    def watched(stream, write, *args, **how):
        def count(batch, number):
            tasks.append(batch.select(F.spark_partition_id()).distinct().count())
            write(batch, number)

        return start(stream, count, *args, **how)

    monkeypatch.setattr(jobs, "start", watched)
    send(tmp_path / "in", "a.json", [click(n, "page_view", "2025-09-03T08:15:02Z", email=f"m{n}@example.com") for n in range(400)])
    run(jobs.events_to_bronze(lake, messages.read_event_stream(spark, str(tmp_path / "in")), str(tmp_path / "cp"),
                              policy={"email": "mask_email"}))
    assert lake.bronze("events_raw").read().count() == 400 and tasks[0] > 1


def test_new_files_are_loaded_once_and_merged(spark, lake, tmp_path):
    header = ",".join(csv_files.csv_columns(ENTITIES["reviews"]))
    box = tmp_path / "landing" / "reviews"
    go = lambda: run(jobs.csv_to_bronze(lake, str(tmp_path / "landing"), "reviews", str(tmp_path / "cp")))
    send(box, "a.csv", [header, "r1,p1,c1,5,t,c,2026-01-01T00:00:00Z"])
    go()
    send(box, "b.csv", [header, "r2,p1,c1,,t,c,"])
    send(box, "c.txt", ["ignored"])
    go(), go()
    assert rows(lake.bronze("reviews_raw").read(), "record_id", "source") == [
        ("r1", "gcs/reviews/a.csv"), ("r2", "gcs/reviews/b.csv")]
    merge_into(lake, "reviews")
    assert rows(lake.silver("reviews").read(), "review_id", "rating") == [("r1", 5), ("r2", None)]


def stored(spark, tmp_path, label, stream):
    table = Table(spark, str(tmp_path / label), stream.schema).create()
    run(jobs.to_table(stream, table, str(tmp_path / f"{label}-cp")))
    return table.read()


def typed(spark, folder):
    good, _ = messages.split_events(messages.read_event_stream(spark, str(folder)), now="2026-03-16 12:00:00")
    return jobs.typed_events(good)


def test_windows_and_late_events(spark, lake, tmp_path):
    inbox = tmp_path / "in"
    send(inbox, "a.json", [*CLICKS, late("2025-09-03T08:45:00Z")])
    counts = jobs.window_counts(typed(spark, inbox))
    table = Table(spark, str(tmp_path / "w"), counts.schema).create()
    run(jobs.to_table(counts, table, str(tmp_path / "w-cp")))
    want = sorted((c["event_type"], 1) for c in CLICKS)
    assert rows(table.read(), "event_type", "event_count") == want
    send(inbox, "b.json", [CLICKS[0] | {"event_id": "too late"}, late("2025-09-03T09:45:00Z")])
    run(jobs.to_table(jobs.window_counts(typed(spark, inbox)), table, str(tmp_path / "w-cp")))
    assert rows(table.read().where("event_type <> 'search'"), "event_type", "event_count") == want
    run(jobs.event_metrics_to_silver(lake, typed(spark, inbox), str(tmp_path / "m-cp")))
    assert lake.silver("event_metrics_5min").read().where("calculated_at is null").count() == 0


def test_time_falls_back_to_arrival(spark, tmp_path):
    doc = {"event_id": "e", "event_type": "t", "timestamp": "soon"}
    df = spark.createDataFrame([(json.dumps(doc),)], "value string")
    good, _ = messages.split_events(df, now="2026-03-16 12:00:00")
    assert str(jobs.typed_events(good).select(F.col("event_timestamp").cast("string")).first()[0]) == "2026-03-16 12:00:00"


def test_sessions_carts_and_funnel_agree_with_batch(spark, tmp_path):
    inbox, docs = tmp_path / "in", []
    for i, (kind, minute) in enumerate([("add_to_cart", 0), ("page_view", 1), ("purchase", 2), ("add_to_cart", 30),
                                        ("page_view", 60), ("add_to_cart", 95), ("add_to_cart", 96)]):
        docs.append({"event_id": str(i), "event_type": kind, "customer_id": "c", "session_id": "s",
                     "timestamp": f"2026-03-16T{12 + minute // 60}:{minute % 60:02d}:00Z"})
    send(inbox, "a.json", docs)
    flush = [late("2026-03-17T00:00:00Z"), {"event_id": "z", "event_type": "purchase", "session_id": "other",
                                            "customer_id": "other", "timestamp": "2026-03-17T00:00:00Z"}]
    send(inbox, "b.json", flush)
    batch = jobs.typed_events(messages.split_events(messages.read_event_files(spark, str(inbox)))[0]).where(
        "customer_id = 'c'")
    sessions = stored(spark, tmp_path, "s", jobs.user_sessions(typed(spark, inbox)))
    assert rows(sessions) == rows(behaviour.user_sessions(batch)) and sessions.count() == 2
    carts = stored(spark, tmp_path, "c", jobs.abandoned_carts(typed(spark, inbox), "5 minutes"))
    assert rows(carts) == rows(behaviour.abandoned_carts(batch, 300)) and carts.count() == 2
    funnel = stored(spark, tmp_path, "f", jobs.live_funnel(typed(spark, inbox), "1 day")).count()
    assert funnel == 0
    hourly = stored(spark, tmp_path, "h", jobs.live_funnel(typed(spark, inbox), "1 hour"))
    assert rows(hourly, "add_to_cart", "orders_completed", "view_to_cart_rate") == [(2, 0, None), (2, 1, None)]


def test_union_of_channels_and_raw_append(spark, tmp_path):
    send(tmp_path / "web", "a.json", CLICKS[:1])
    send(tmp_path / "pos", "a.json", CLICKS[:1])
    both = messages.flatten({c: messages.read_event_stream(spark, str(tmp_path / c)) for c in ("web", "pos")})
    assert rows(stored(spark, tmp_path, "u", both), "channel") == [("pos",), ("web",)]
    run(jobs.raw_append(messages.read_event_stream(spark, str(tmp_path / "web")), str(tmp_path / "raw"), str(tmp_path / "raw-cp")))
    assert json.loads(spark.read.parquet(str(tmp_path / "raw")).first().value) == CLICKS[0]
