import os

import pytest
from pyspark.sql import functions as F

from store_rows import rows
from mercato.lakehouse import Lakehouse
from mercato.operators.ingest import csv_to_bronze
from mercato.plans import gold, medallion

ENTITIES_WITH_SAMPLES = ("customers", "products", "orders", "order_items", "payments", "inventory", "reviews")


@pytest.fixture(scope="module")
def shop(spark):
    day = F.lit("2026-01-04 10:00:00").cast("timestamp")
    orders = spark.createDataFrame([
        ("o1", "c1", "completed", 10.0), ("o2", "c1", "delivered", 30.0), ("o3", "c2", "cancelled", 99.0),
        ("o4", "c2", "completed", 5.0), ("o5", None, "completed", None)],
        "order_id string, customer_id string, status string, total_amount double").select(
        "*", F.lit("USD").alias("currency"), day.alias("ordered_at"))
    items = spark.createDataFrame([("o1", "p1", 1, 4.0), ("o1", "p2", 2, 6.0), ("o2", "p1", 3, 30.0),
                                   ("o3", "p1", 1, 99.0), ("o5", "p9", 1, 1.0)],
                                  "order_id string, product_id string, quantity long, total_price double")
    reviews = spark.createDataFrame([("r1", "p1", 5), ("r2", "p1", 2), ("r3", "p3", 4)],
                                    "review_id string, product_id string, rating long")
    products = spark.createDataFrame([("p1", "A", "x"), ("p2", "B", "x"), ("p3", "C", "y")],
                                     "product_id string, name string, category string")
    customers = spark.createDataFrame([("c1", "Ana", "Diaz", "MX"), ("c2", "Bo", "Cruz", "CO"), ("c3", "No", "One", "CO")],
                                      "customer_id string, first_name string, last_name string, country string")
    frames = {"orders": orders, "order_items": items, "reviews": reviews, "products": products, "customers": customers}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames


def test_daily_revenue_matches_the_plain_join(spark, shop):
    want = spark.sql("""select date(o.ordered_at) date, sum(o.total_amount) total_revenue,
        count(distinct o.order_id) order_count, avg(o.total_amount) avg_order_value, sum(oi.quantity) items_sold,
        count(distinct o.customer_id) unique_customers, o.currency from orders o join order_items oi
        on o.order_id = oi.order_id where o.status in ('completed', 'delivered') group by all""")
    got = gold.daily_revenue(shop["orders"], shop["order_items"])
    assert rows(got) == rows(want) and got.columns == want.columns
    assert rows(gold.daily_revenue_exact(shop["orders"], shop["order_items"]), "total_revenue") == [(40.0,)]


def test_product_metrics_match_the_plain_join(spark, shop):
    want = spark.sql("""select p.product_id, p.name product_name, p.category,
        coalesce(sum(oi.total_price), 0d) total_revenue, coalesce(sum(oi.quantity), 0) units_sold,
        count(distinct oi.order_id) order_count, avg(r.rating) avg_rating, count(distinct r.review_id) review_count
        from products p left join order_items oi on p.product_id = oi.product_id
        left join reviews r on p.product_id = r.product_id group by all""")
    assert rows(gold.product_metrics(shop["products"], shop["order_items"], shop["reviews"])) == rows(want)
    exact = gold.product_metrics_exact(shop["products"], shop["order_items"], shop["reviews"])
    assert rows(exact, "product_id", "total_revenue", "units_sold") == [("p1", 133.0, 5), ("p2", 6.0, 2), ("p3", 0.0, 0)]


def test_customer_metrics(shop):
    got = gold.customer_metrics(shop["customers"], shop["orders"], "2026-01-14")
    assert rows(got, "customer_id", "total_spent", "order_count", "days_since_last_order", "customer_segment") == [
        ("c1", 40.0, 2, 10, "Returning"), ("c2", 5.0, 1, 10, "New")]


@pytest.mark.parametrize("orders, want", [(1, "New"), (2, "Returning"), (5, "Loyal"), (9, "Loyal"), (10, "VIP")])
def test_segments(spark, orders, want):
    assert spark.range(1).select(gold.segment(F.lit(orders)).alias("s")).first().s == want


def test_monthly(spark, shop):
    full = gold.monthly_kpis_full(shop["orders"])
    assert rows(full, "total_revenue", "order_count", "active_customers", "new_customers", "returning_customers") == [
        (45.0, 4, 2, 2, 0)]
    assert gold.monthly_kpis(shop["orders"], month_as_date=True).schema["month"].dataType.simpleString() == "date"
    assert rows(gold.monthly_kpis(shop["orders"], approximate=True), "active_customers") == [(2,)]
    undated = shop["orders"].withColumn("ordered_at", F.lit(None).cast("timestamp"))
    assert rows(gold.monthly_kpis(undated), "month", "order_count") == [(None, 4)]


def test_rates_are_null_without_a_divisor(spark):
    events = spark.createDataFrame([("purchase",), ("search",)], "event_type string").withColumn(
        "event_timestamp", F.lit("2026-01-01").cast("timestamp"))
    r = gold.conversion_funnel(events).first()
    assert r.orders_completed == 1 and r.checkout_to_purchase_rate is None and r.page_views == 0
    short = gold.conversion_funnel(events, (("searches", "search", None), ("bought", "purchase", "rate"))).first()
    assert (short.searches, short.bought, short.rate) == (1, 1, 1.0)
    assert gold.traffic_stats(events).first().search == 1


def test_top_products(shop):
    got = gold.top_products_by_category(shop["products"], shop["order_items"], 1)
    assert rows(got, "category", "product_id", "rank_in_category") == [("x", "p1", 1)]


def test_return_rate(spark, shop):
    pays = spark.createDataFrame([("o1", "refunded"), ("o1", "refunded"), ("o2", "completed")], "order_id string, status string")
    got = gold.product_return_rate(shop["order_items"], pays)
    assert rows(got, "product_id", "returned_orders", "order_count") == [("p1", 1, 3), ("p2", 1, 1), ("p9", 0, 1)]


# ---- golden figures of the store's sample files, if a folder with them is named


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    folder = os.environ.get("MERCATO_SAMPLE_DIR")
    if not folder:
        pytest.skip("MERCATO_SAMPLE_DIR names no sample files")
    root = tmp_path_factory.mktemp("sample")
    for name in ENTITIES_WITH_SAMPLES:
        (root / "landing" / name).mkdir(parents=True)
        with open(f"{folder}/{name}.csv", encoding="utf-8") as src:
            (root / "landing" / name / "data.csv").write_text(src.read(), encoding="utf-8")
    lake = Lakehouse(spark, str(root / "lake")).create()
    for name in ENTITIES_WITH_SAMPLES:
        csv_to_bronze(lake, str(root / "landing"), name)
    medallion.bronze_to_silver(lake)
    return {name: lake.silver(name).read().cache() for name in ENTITIES_WITH_SAMPLES}


def total(df, *columns):
    return tuple(round(v, 2) for v in df.agg(*[F.sum(c) for c in columns]).first())


def test_golden_revenue(sample):
    asis = gold.daily_revenue(sample["orders"], sample["order_items"])
    assert asis.count() == 50 and total(asis, "total_revenue", "order_count", "items_sold") == (701787.82, 67, 361)
    first = asis.orderBy("date").head(2)
    assert (str(first[0].date), first[0].total_revenue, first[0].avg_order_value, first[0].items_sold) == (
        "2026-01-04", 22817.80, 5704.45, 9)
    assert (first[1].total_revenue, round(first[1].avg_order_value, 4), first[1].unique_customers) == (
        17052.67, 4263.1675, 2)
    assert total(gold.daily_revenue_exact(sample["orders"], sample["order_items"]), "total_revenue") == (237861.16,)


def test_golden_customers(sample):
    got = gold.customer_metrics(sample["customers"], sample["orders"])
    assert got.count() == 37 and total(got, "total_spent") == (237861.16,)
    assert rows(got.groupBy("customer_segment").count()) == [("Loyal", 1), ("New", 21), ("Returning", 15)]


def test_golden_products(sample):
    args = sample["products"], sample["order_items"], sample["reviews"]
    asis = gold.product_metrics(*args)
    assert asis.count() == 20 and asis.where("avg_rating is null").count() == 6
    assert total(asis, "total_revenue", "units_sold", "order_count", "review_count") == (616947.65, 987, 250, 30)
    one = {r.product_id: r for r in asis.collect()}
    assert (one["prod-0001"].total_revenue, one["prod-0001"].units_sold, one["prod-0001"].order_count) == (23443.07, 23, 14)
    assert (one["prod-0005"].total_revenue, one["prod-0005"].avg_rating, one["prod-0005"].review_count) == (18211.38, 5.0, 3)
    assert total(gold.product_metrics_exact(*args), "total_revenue", "units_sold") == (339923.15, 526)
    top = gold.top_products_by_category(sample["products"], sample["order_items"], 2)
    assert rows(top, "category", "product_id", "total_revenue") == [
        ("Clothing", "prod-0018", 36625.82), ("Clothing", "prod-0020", 37206.81),
        ("Electronics", "prod-0003", 30931.28), ("Electronics", "prod-0008", 24812.28)]


def test_golden_months(sample):
    got = gold.monthly_kpis_full(sample["orders"]).orderBy("month").collect()
    assert [(r.total_revenue, r.order_count, r.active_customers, round(r.avg_order_value, 6), r.new_customers,
             r.returning_customers) for r in got] == [
        (96717.56, 27, 22, 3582.131852, 22, 0), (95306.90, 28, 19, 3403.817857, 11, 8),
        (45836.70, 12, 10, 3819.725, 2, 8)]


def test_golden_silver(sample):
    assert {n: df.count() for n, df in sample.items()} == {
        "customers": 50, "products": 20, "orders": 100, "order_items": 250, "payments": 87, "inventory": 38,
        "reviews": 30}
    assert sample["orders"].where("shipped_at is null").count() == 21
    assert sample["products"].where("is_active").count() == 16


def test_huge_small_and_missing_amounts(spark):
    """Sums survive any size; NaN and infinity count as missing, in the divisor too."""
    orders = spark.createDataFrame([("o1", "c1", 1e15), ("o2", "c1", float("nan")), ("o3", "c1", 0.000001), ("o4", "c1", float("inf"))],
                                   "order_id string, customer_id string, total_amount double").select(
        "*", F.lit("completed").alias("status"), F.lit("USD").alias("currency"),
        F.lit("2026-01-04 10:00:00").cast("timestamp").alias("ordered_at"))
    got = gold.monthly_kpis(orders).first()
    assert got.total_revenue == 1e15 and got.avg_order_value == 5e14 and got.order_count == 4
    small = gold.monthly_kpis(orders.where("total_amount < 1")).first()
    assert small.total_revenue == 0.000001
