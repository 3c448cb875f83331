import json
import random

import pytest
from pyspark.sql import functions as F

from store_rows import rows
from mercato.sources import messages

BAD = ["", "0", "x", "[1]", '"x"', "null", '{"a":1} xyz', "{'event_id':'a','event_type':'b'}",
       '{"event_id":"a","event_type":"b"} {"event_id":"c","event_type":"d"}',
       '{"event_id":"a","event_type":"b"},{"event_id":"c","event_type":"d"}', '{"event_id":"a","event_type":"b"}}',
       '{"event_id":"a","event_type":"b"}}{', '{"event_id":"a","event_type":"b"},"event_id":"c"}', '{"event_id":"a","event_type":"b"']


def check(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return {r.raw_message: r for r in messages.check_events(df, now="2026-01-01 00:00:00").collect()}


def test_malformed_messages(spark):
    got = check(spark, BAD)
    assert {t: got[t].error_type for t in BAD} == {t: "invalid_json" for t in BAD}


@pytest.mark.parametrize("value", ["", 0, 0.0, -0.0, False, [], {}, None])
def test_falsy_ids_are_missing(spark, value):
    for doc in ({"event_id": value, "event_type": "x"}, {"event_id": "x", "event_type": value}):
        text = json.dumps(doc)
        assert check(spark, [text])[text].error_type == "missing_required_fields"


@pytest.mark.parametrize("value", ["0", "false", "[]", "{}", "{x", 7, True, [1], {"a": 1}, "a b"])
def test_truthy_ids_are_valid(spark, value):
    text = json.dumps({"event_type": "x", "event_id": value, "other": 0})
    got = check(spark, [text])[text]
    assert got.error_type is None
    if isinstance(value, str):
        assert got.event_id == value


def test_against_full_decoder(spark):
    texts = [t for t in BAD if t] + [json.dumps({"event_id": a, "event_type": b}, indent=1)
                                     for a in ("0", 0, "", None, [], "é") for b in ("v", {}, 0)]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    want = {r.value: r.verdict for r in messages.strict_check(df).collect()}
    got = check(spark, texts)
    assert {t: got[t].error_type or "valid" for t in texts} == want


def test_against_full_decoder_on_damaged_documents(spark):
    rng, texts = random.Random(11), set()
    values = ["a", "", 0, -0.0, 1.5, True, False, None, [], {}, [1], {"a": [0]}, "0", "{x", "[y", 'q"o\\t', "é"]
    while len(texts) < 3000:
        doc = {k: rng.choice(values) for k in ("event_id", "event_type", "x") if rng.random() < 0.9}
        text = json.dumps(doc, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            at = rng.randrange(len(text) + 1)
            text = rng.choice([
                text[:at] + text[at + 1:], text[:at] + rng.choice('{}[]",:0 \t\n1ae-.\'/') + text[at:],
                text + rng.choice(["}", " ", " {}", ",{}", "null", "//c", "}{"])])
        texts.add(text)
    df = spark.createDataFrame([(t, t) for t in texts if t], "value string, sent string")
    want = {r.value: r.verdict for r in messages.strict_check(df).collect()}
    got = {r.sent: r.error_type or "valid" for r in messages.check_events(df).collect()}
    assert {t: (got[t], want[t]) for t in want if got[t] != want[t]} == {}


def test_missing_id_detail_and_last_duplicate_key(spark):
    got = check(spark, ['{"some_field":"some_value"}', '{"event_id":"a","event_type":"t","event_id":"z"}'])
    missing = got['{"some_field":"some_value"}']
    assert (missing.error_type, missing.error_detail) == (
        "missing_required_fields", "event_id=None, event_type=None")
    assert got['{"event_id":"a","event_type":"t","event_id":"z"}'].event_id == "z"


def test_bytes_and_long_messages(spark):
    ok = '{"event_id":"a","event_type":"é"}'.encode()
    df = spark.createDataFrame([(bytearray(ok),), (bytearray(b'{"event_id":"\xff","event_type":"x"}'),),
                                (bytearray(b"y" * 20_000),)], "value binary")
    good, bad = messages.split_events(df)
    assert [tuple(r) for r in good.select("event_id", "event_type", "source").collect()] == [
        ("a", "é", "streaming/pubsub")]
    assert sorted(r.n for r in bad.select(F.length("raw_message").alias("n")).collect())[-1] == 20_000
    _, cut = messages.split_events(df, raw_limit=messages.RAW_LIMIT)
    assert sorted(r.n for r in cut.select(F.length("raw_message").alias("n")).collect())[-1] == 10_000
    assert {r.error_type for r in bad.collect()} == {"invalid_json"}


def test_a_long_message_can_be_replayed(spark):
    broken = '{"event_id":"a","event_type":"view","note":"' + "x" * 12_000 + '"'
    _, bad = messages.split_events(spark.createDataFrame([(broken,)], "value string"))
    again, still = messages.replay_errors(bad, F.concat("raw_message", F.lit("}")))
    assert [r.event_id for r in again.collect()] == ["a"] and still.isEmpty()


def test_payload_is_kept_and_replay_recovers(spark):
    text = '  {"event_id":"a", "event_type":"t", "n":1.50}'
    df = spark.createDataFrame([(text,), ('{"event_id":"b","event_type":"t"',)], "value string")
    good, bad = messages.split_events(df)
    assert good.first().raw_payload == text.strip()
    again, still = messages.replay_errors(bad, F.concat("raw_message", F.lit("}")))
    assert rows(again, "event_id") == [("b",)] and still.isEmpty()


def test_flatten_keeps_duplicates(spark):
    a = spark.createDataFrame([("m",), ("m",)], "value string")
    assert rows(messages.flatten({"web": a, "pos": a.limit(1)})) == [("m", "pos"), ("m", "web"), ("m", "web")]
