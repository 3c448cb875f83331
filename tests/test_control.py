import pytest
from pyspark.sql import functions as F

from store_rows import rows
from mercato.operators import checks, governance as g
from test_merge import deliver
from mercato.operators.merge import merge_into


def customers(spark):
    return spark.createDataFrame([("a", "MX", "e"), ("b", "CO", "e"), ("c", "ES", None)],
                                 "customer_id string, country string, email string")


def test_row_policies(spark):
    seen = lambda *groups: rows(g.apply_row_policies(customers(spark), g.CUSTOMER_POLICIES, groups), "customer_id")
    assert seen() == [] and seen("strangers") == []
    assert seen("mx-analysts") == [("a",)] and seen("mx-analysts", "co-analysts") == [("a",), ("b",)]
    assert len(seen("data-admins")) == 3
    assert g.apply_row_policies(customers(spark), [], []).count() == 3


def test_columns_and_secure_view(spark, lake):
    deliver(lake, "customers", [{"id": "a", "country": "MX", "email": "m@x.io", "first_name": "Ana"},
                                {"id": "b", "country": "CO", "email": "b@x.io"}], "2026-01-01 00:00:00")
    merge_into(lake, "customers")
    view = g.secure_view(lake, "customers", ["mx-analysts"], g.LOW)
    assert rows(view, "customer_id", "email", "first_name", "country") == [("a", None, None, None)]
    assert rows(g.secure_view(lake, "customers", ["mx-analysts"], g.MEDIUM), "email", "first_name", "country") == [
        (None, "Ana", "MX")]
    assert rows(g.secure_view(lake, "customers", ["data-admins"], g.HIGH), "email") == [("b@x.io",), ("m@x.io",)]
    assert g.secure_view(lake, "products", []).columns[0] == "product_id"


def test_retention(spark, lake):
    for day in ("2024-01-01", "2024-01-02", "2026-01-01"):
        deliver(lake, "orders", [{"order_id": day}], f"{day} 12:00:00")
    assert g.enforce_retention(lake, "bronze", "orders_raw", "2026-01-01") == ["2024-01-01"]
    assert rows(lake.bronze("orders_raw").read(), "record_id") == [("2024-01-02",), ("2026-01-01",)]
    assert g.enforce_retention(lake, "bronze", "orders_raw", "2026-01-01") == []
    with pytest.raises(ValueError):
        g.enforce_retention(lake, "silver", "customers", "2026-01-01")
    deliver(lake, "customers", [{"id": "old", "updated_at": "2019-01-01T00:00:00Z"}, {"id": "new", "updated_at": "2025-06-01T00:00:00Z"},
                                {"id": "undated"}], "2026-01-01 00:00:00")
    merge_into(lake, "customers")
    g.expire_rows(lake, "silver", "customers", "updated_at", "2026-01-01")
    assert rows(lake.silver("customers").read(), "customer_id") == [("new",), ("undated",)]
    old = g.expired_days(lake.bronze("orders_raw").read(), "ingested_at", 730, "2026-01-02")
    assert rows(old.select(F.col("day").cast("string"), "rows")) == [("2024-01-02", 1)]


def test_sources_and_loads(spark):
    df = spark.createDataFrame([("f1", "a"), ("f1", "b"), ("f2", "c"), ("f3", "d"), ("f3", "d")],
                               "source string, record_id string")
    assert rows(checks.duplicate_sources(df)) == [("f1", 2), ("f3", 2)]
    assert rows(checks.duplicate_loads(df)) == [("f3", "d", 2)]
    assert rows(checks.table_counts({"b": df, "a": df.limit(1)})) == [("a", 1), ("b", 5)]
    assert [r.record_id for r in checks.latest_ingested(df, 2, "source", "record_id").collect()] == ["d", "d"]


def test_quality_rules_find_each_fault(spark):
    ts = lambda t: F.lit(t).cast("timestamp")
    orders = spark.createDataFrame([("o1", "c1", "completed"), ("o1", "c9", "odd"), (None, None, None)],
                                   "order_id string, customer_id string, status string").select(
        "*", ts("2026-01-02").alias("ordered_at"), ts("2026-01-01").alias("shipped_at"))
    items = spark.createDataFrame([("i1", "o1", "p1", 2, 5.0, 9.5, 0.5), ("i2", "oX", "pX", 0, 5.0, 9.0, 0.0)],
                                  "order_item_id string, order_id string, product_id string, quantity long, "
                                  "unit_price double, total_price double, discount double")
    people = spark.createDataFrame([("c1",)], "customer_id string")
    stock = spark.createDataFrame([("p1", "w", 1, 5)], "product_id string, warehouse string, quantity_available long, quantity_reserved long")
    pays = spark.createDataFrame([("x", "oX", "lost")], "payment_id string, order_id string, status string")
    got = {(r.table_name, r.rule): r.failures for r in checks.quality_report(
        {"orders": orders, "order_items": items, "customers": people, "inventory": stock, "payments": pays}).collect()}
    assert got == {
        ("orders", "key_present"): 1, ("orders", "status_known"): 2, ("orders", "shipped_after_ordered"): 3,
        ("orders", "unique_key"): 1, ("order_items", "key_present"): 0, ("order_items", "quantity_positive"): 1,
        ("order_items", "total_adds_up"): 1, ("order_items", "unique_key"): 0, ("customers", "key_present"): 0,
        ("customers", "unique_key"): 0, ("inventory", "key_present"): 0,
        ("inventory", "reserved_within_available"): 1, ("inventory", "unique_key"): 0, ("payments", "key_present"): 0,
        ("payments", "status_known"): 1, ("payments", "unique_key"): 0, ("orders", "customer_id_exists"): 1,
        ("order_items", "order_id_exists"): 1, ("payments", "order_id_exists"): 1}


def test_alerts(spark):
    df = spark.createDataFrame([("a", 10), ("a", 20), ("b", 700)], "error_type string, t int").withColumn(
        "error_timestamp", F.timestamp_seconds("t"))
    assert rows(checks.error_summary(df)) == [("a", 2), ("b", 1)]
    assert rows(checks.error_alerts(df), "errors") == [(1,), (2,)]
    assert rows(checks.error_alerts(df, above=1), "errors") == [(2,)]


def test_tasks_of_a_shuffle_grow_in_number_with_its_bytes(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        keys = spark.range(0, 400_000, 1, 8).groupBy(F.sha2(F.col("id").cast("string"), 256).alias("key")).agg(F.count("*").alias("n"))
        assert keys.select(F.spark_partition_id()).distinct().count() > 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
