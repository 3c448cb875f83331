import json

import pytest
from pyspark.sql import functions as F

from store_rows import rows
from mercato.lakehouse import Table, TableChanged
from mercato.operators import merge
from mercato.operators.privacy import deidentify
from mercato.plans import gold, medallion
from mercato.schemas import ENTITIES


def deliver(lake, entity, docs, at, source="gcs/a.csv"):
    """Append documents to an entity's Bronze table."""
    spec = ENTITIES[entity]
    if spec.carried:
        data = [(d.get("event_id"), d.get("event_type"), json.dumps(d), source) for d in docs]
        names = "event_id string, event_type string, raw_payload string, source string"
    else:
        data = [(str(next(iter(d.values()), "")), json.dumps(d), source) for d in docs]
        names = "record_id string, raw_data string, source string"
    df = lake.spark.createDataFrame(data, names).withColumn("ingested_at", F.lit(at).cast("timestamp"))
    lake.bronze(spec.bronze_table).append(df)


def silver(lake, entity, *columns):
    return rows(lake.silver(entity).read(), *columns)


def test_customer_update_keeps_created_at(lake):
    deliver(lake, "customers", [{"id": "c1", "address": "old", "email": "e", "created_at": "2026-01-01T00:00:00Z"}],
            "2026-01-01 01:00:00")
    merge.merge_into(lake, "customers")
    deliver(lake, "customers", [{"id": "c1", "address": "new", "email": None, "created_at": "2026-02-01T00:00:00Z"},
                                {"id": "c2"}], "2026-01-02 01:00:00")
    merge.merge_into(lake, "customers")
    got = rows(lake.silver("customers").read().select(
        "customer_id", "address", "email", F.to_date("created_at").cast("string").alias("d")))
    assert got == [("c1", "new", None, "2026-01-01"), ("c2", None, None, None)]


def test_merge_twice_changes_only_processed_at(lake):
    deliver(lake, "orders", [{"order_id": f"o{i}", "status": "pending", "total_amount": "5",
                              "ordered_at": f"2026-01-0{i}T10:00:00Z"} for i in range(1, 5)], "2026-01-05 00:00:00")
    merge.merge_into(lake, "orders", now="2026-01-06 00:00:00")
    first = rows(lake.silver("orders").read().drop("processed_at"))
    merge.merge_into(lake, "orders", now="2026-01-07 00:00:00")
    assert rows(lake.silver("orders").read().drop("processed_at")) == first
    assert {r.p for r in lake.silver("orders").read().select(
        F.col("processed_at").cast("string").alias("p")).collect()} == {"2026-01-07 00:00:00"}


def test_order_update_null_overwrites_and_frozen_columns(lake):
    first = {"order_id": "o1", "status": "shipped", "total_amount": "10", "ordered_at": "2026-01-01T00:00:00Z",
             "shipped_at": "2026-01-02T00:00:00Z"}
    deliver(lake, "orders", [first], "2026-01-02 00:00:00")
    merge.merge_into(lake, "orders")
    deliver(lake, "orders", [first | {"status": "cancelled", "total_amount": "99", "shipped_at": "",
                                      "ordered_at": "2026-03-01T00:00:00Z"}], "2026-01-03 00:00:00")
    merge.merge_into(lake, "orders", since="2026-01-02 12:00:00")
    assert silver(lake, "orders", "order_id", "status", "total_amount", "shipped_at") == [
        ("o1", "cancelled", 10.0, None)]
    assert lake.silver("orders").days() == ["2026-01-01"]


def test_only_touched_days_are_rewritten(lake):
    docs = [{"order_id": f"o{d}", "status": "pending", "ordered_at": f"2026-01-0{d}T10:00:00Z"} for d in (1, 2, 3)]
    docs.append({"order_id": "o0", "status": "pending"})
    deliver(lake, "orders", docs, "2026-01-04 00:00:00")
    merge.merge_into(lake, "orders")
    before = lake.silver("orders").state()["parts"]
    assert set(before) == {"2026-01-01", "2026-01-02", "2026-01-03", "__HIVE_DEFAULT_PARTITION__"}
    deliver(lake, "orders", [docs[1] | {"status": "shipped"}, docs[3] | {"status": "shipped"},
                             {"order_id": "o9", "status": "new", "ordered_at": "2026-01-03T11:00:00Z"}],
            "2026-01-05 00:00:00")
    merge.merge_into(lake, "orders", since="2026-01-04 00:00:00")
    after = lake.silver("orders").state()["parts"]
    assert after["2026-01-01"] == before["2026-01-01"]
    assert after["2026-01-02"] != before["2026-01-02"]
    assert after["2026-01-03"][0] == before["2026-01-03"][0] and len(after["2026-01-03"]) == 2
    assert silver(lake, "orders", "order_id", "status") == [
        ("o0", "shipped"), ("o1", "pending"), ("o2", "shipped"), ("o3", "pending"), ("o9", "new")]


def test_product_category_is_frozen_and_event_redelivery_ignored(lake):
    deliver(lake, "products", [{"id": "p1", "category": "A", "price": "1"}], "2026-01-01 00:00:00")
    deliver(lake, "events", [{"event_id": "e1", "event_type": "v", "device": "tablet"}], "2026-01-01 00:00:00")
    medallion.bronze_to_silver(lake, ["products", "events"])
    deliver(lake, "products", [{"id": "p1", "category": "B", "price": "2"}], "2026-01-02 00:00:00")
    deliver(lake, "events", [{"event_id": "e1", "event_type": "v", "device": "mobile"}], "2026-01-02 00:00:00")
    medallion.bronze_to_silver(lake, ["products", "events"])
    assert silver(lake, "products", "category", "price") == [("A", 2.0)]
    assert silver(lake, "events", "event_id", "device") == [("e1", "tablet")]


def test_second_warehouse_is_inserted_and_older_variant_skips_it(spark, lake):
    deliver(lake, "inventory", [{"product_id": "p", "warehouse": "w1", "quantity_available": "1"}], "2026-01-01 00:00:00")
    merge.merge_into(lake, "inventory")
    deliver(lake, "inventory", [{"product_id": "p", "warehouse": "w2", "quantity_available": "2"}], "2026-01-02 00:00:00")
    spec, old = ENTITIES["inventory"], lake.silver("inventory").read()
    arriving = merge.batch(lake.bronze("inventory_raw").read(), spec)
    assert merge.insert_if_absent(old, arriving, spec, ["product_id"]).count() == 1
    assert merge.insert_if_absent(old, arriving, spec).count() == 2
    merge.merge_into(lake, "inventory")
    assert silver(lake, "inventory", "warehouse", "quantity_available") == [("w1", 1), ("w2", 2)]


def test_duplicates_in_one_batch(lake):
    deliver(lake, "customers", [{"id": "c", "city": "first"}], "2026-01-01 00:00:00")
    deliver(lake, "customers", [{"id": "c", "city": "second"}], "2026-01-02 00:00:00")
    with pytest.raises(merge.DuplicateKeys):
        merge.merge_into(lake, "customers", on_duplicate="error")
    with pytest.raises(ValueError):
        merge.merge_into(lake, "customers", on_duplicate="all")
    merge.merge_into(lake, "customers")
    assert silver(lake, "customers", "city") == [("second",)]
    for at in ("2026-01-01 00:00:00", "2026-01-02 00:00:00"):
        deliver(lake, "reviews", [{"review_id": "r", "rating": "5"}], at)
    merge.merge_into(lake, "reviews", on_duplicate="all")
    assert lake.silver("reviews").read().count() == 2


def test_null_keys_are_rejected(lake):
    deliver(lake, "payments", [{"payment_id": None, "amount": "1"}, {"payment_id": "x"}, {"payment_id": {"a": 1}}],
            "2026-01-01 00:00:00")
    merge.merge_into(lake, "payments")
    assert silver(lake, "payments", "payment_id") == [("x",)]
    assert merge.rejected(lake.bronze("payments_raw").read(), ENTITIES["payments"]).count() == 2


def test_small_source_merge_agrees(spark):
    t = spark.createDataFrame([(1, "a", "x", 0), (2, "b", "y", 0), (3, None, "z", 0)],
                              "k int, u string, f string, processed_at int")
    s = spark.createDataFrame([(2, None, "Y", 1), (3, "c", None, 1), (4, "d", "w", 1)], t.schema)
    full = merge.upsert(t, s, ["k"], ["u"])
    assert rows(full) == [(1, "a", "x", 0), (2, None, "y", 1), (3, "c", "z", 1), (4, "d", "w", 1)]
    assert rows(merge.upsert(t, s, ["k"], ["u"], small_source=True)) == rows(full)


def test_not_in_follows_sql(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    for listed in ([], [(1,)], [(1,), (None,)], [(5,), (5,)]):
        right = spark.createDataFrame(listed, "j int")
        left.createOrReplaceTempView("l"), right.createOrReplaceTempView("r")
        want = rows(spark.sql("select * from l where k not in (select j from r)"))
        assert rows(merge.not_in(left, "k", right, "j")) == want, listed


def test_require_raises(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    ok, bad = merge.split_required(df, ["k"])
    assert rows(ok) == [(1, "a")] and rows(bad) == [(None, "b")]
    with pytest.raises(Exception, match="k is required"):
        merge.require(df, ["k"]).collect()


def test_merge_can_protect_columns(lake):
    deliver(lake, "customers", [{"id": "c", "email": "maria@example.com", "phone": "+1234567890",
                                 "address": "Reforma 123", "city": "CDMX", "country": "MX"}], "2026-01-01 00:00:00")
    merge.merge_into(lake, "customers", protect=lambda df: deidentify(df, key="0123456789abcdef"))
    (email, phone, address), = silver(lake, "customers", "email", "phone", "address")
    assert email.startswith("k1:") and phone == "+*********0" and address == "CDMX, MX"


def test_order_of_entities():
    order = medallion.merge_order()
    assert len(order) == 8
    for name in order:
        assert all(order.index(a) < order.index(name) for a in ENTITIES[name].after)
    assert medallion.merge_order(["order_items"]) == ["order_items"]


def test_views(lake):
    deliver(lake, "orders", [{"order_id": "o", "customer_id": "c", "status": "completed", "total_amount": "4",
                              "ordered_at": "2026-01-01T00:00:00Z", "currency": "USD"}], "2026-01-01 00:00:00")
    merge.merge_into(lake, "orders")
    assert len(gold.register_views(lake)) == 5
    assert lake.spark.sql("select total_revenue from gold_monthly_kpis").first()[0] == 4.0
    assert lake.spark.sql("select * from gold_daily_revenue").count() == 0
    assert gold.view(lake, "monthly_kpis", ("2026-01-01", "2026-01-31")).count() == 1
    assert gold.view(lake, "monthly_kpis", ("2026-02-01", "2026-02-28")).count() == 0
    with pytest.raises(ValueError):
        gold.view(lake, "customer_metrics", ("2026-02-01", "2026-02-28"))


def test_only_new_takes_each_bronze_write_once_however_late(lake):
    deliver(lake, "customers", [{"id": "c1", "address": "a"}], "2026-01-05 00:00:00")
    merge.merge_into(lake, "customers", only_new=True)
    deliver(lake, "customers", [{"id": "c2", "address": "b"}], "2026-01-01 00:00:00")  # older rows, committed later
    deliver(lake, "customers", [{"id": "c1", "address": "new"}], "2026-01-06 00:00:00")
    lake.bronze("customers").compact()
    merge.merge_into(lake, "customers", only_new=True)
    assert silver(lake, "customers", "customer_id", "address") == [("c1", "new"), ("c2", "b")]
    before = lake.silver("customers").state()["version"]
    merge.merge_into(lake, "customers", only_new=True)
    assert lake.silver("customers").state()["version"] == before


@pytest.mark.parametrize("since", [None, "2026-01-01"])
@pytest.mark.parametrize("entity, doc", [
    ("reviews", {"review_id": "r1", "product_id": "p", "rating": "5", "created_at": "2026-01-01T00:00:00Z"}),
    ("orders", {"order_id": "o1", "status": "pending", "ordered_at": "2026-01-01T00:00:00Z"}),
    ("customers", {"id": "c1"})])
def test_racing_merges_insert_once(lake, monkeypatch, entity, doc, since):
    deliver(lake, entity, [doc], "2026-01-02 00:00:00")
    write, raced = Table._write, []

    def slow_write(self, df):
        out = write(self, df)
        if "/silver/" in self.path and not raced:
            raced.append(True)  # between this merge's write and its commit the other one runs
            deliver(lake, entity, [doc], "2026-01-03 00:00:00")
            merge.merge_into(lake, entity)
        return out

    monkeypatch.setattr(Table, "_write", slow_write)
    if since is None:
        merge.merge_into(lake, entity)  # the other one has merged all that this one has: nothing to do
    else:
        with pytest.raises(TableChanged):
            merge.merge_into(lake, entity, since=since)
    assert raced and lake.silver(entity).read().count() == 1
    merge.merge_into(lake, entity)
    assert lake.silver(entity).read().count() == 1


@pytest.mark.parametrize("since, taken", [("2026-03-01 00:30:00+02:00", 2), ("2026-02-28 22:45:00", 1), ("2026-03-01 00:30:00", 0)])
def test_since_is_an_instant(lake, since, taken):
    deliver(lake, "customers", [{"id": "c1"}], "2026-02-28 22:40:00")
    deliver(lake, "customers", [{"id": "c2"}], "2026-02-28 23:10:00")
    merge.merge_into(lake, "customers", since=since)
    assert lake.silver("customers").read().count() == taken
