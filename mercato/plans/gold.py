"""Gold metrics as lazy DataFrames over Silver.

Where a plain query multiplies rows by joining children of one parent, the
children are counted first and the multiplier applied as arithmetic: the same
figures, no multiplied rows, and a key that holds most rows is already folded
before it is shuffled. Silver keys of customers, products and orders are unique
(the merge sees to it), so counting their rows is counting distinct keys.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from mercato.functions.casts import money, money_sum
from mercato.functions.instants import day, ratio
from mercato.lakehouse import Lakehouse
from mercato.schemas import EVENT_TYPES, PAID_STATUSES


def paid(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("status").isin(*PAID_STATUSES))


def _mean(total: Column, count: Column) -> Column:
    return F.try_divide(total.cast("double"), count)


def _orders_with_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    per_order = items.groupBy("order_id").agg(
        F.count("*").cast("int").alias("lines"), F.sum("quantity").alias("quantity"))
    return paid(orders).join(per_order, "order_id")


def _distinct(column: str, approximate: bool) -> Column:
    return F.approx_count_distinct(column) if approximate else F.count_distinct(column)


def _revenue_by_day(per_order: DataFrame, weight: Column, approximate: bool) -> DataFrame:
    counted = F.sum(F.when(money(F.col("total_amount")).isNotNull(), weight))
    total = F.sum(money(F.col("total_amount")) * weight)
    return per_order.groupBy(F.to_date("ordered_at").alias("date"), "currency").agg(
        total.cast("double").alias("total_revenue"),
        F.count("order_id").alias("order_count"),
        _mean(total, counted).alias("avg_order_value"),
        F.sum("quantity").alias("items_sold"),
        _distinct("customer_id", approximate).alias("unique_customers"),
    ).select("date", "total_revenue", "order_count", "avg_order_value", "items_sold",
             "unique_customers", "currency")


def daily_revenue(orders: DataFrame, items: DataFrame, approximate: bool = False) -> DataFrame:
    """Paid revenue per day with the joins the store uses: an order counts once per item.

    ``approximate`` estimates the distinct customers, which spares a shuffle.
    """
    return _revenue_by_day(_orders_with_items(orders, items), F.col("lines"), approximate)


def daily_revenue_exact(orders: DataFrame, items: DataFrame, approximate: bool = False) -> DataFrame:
    """The same days with each order counted once."""
    return _revenue_by_day(_orders_with_items(orders, items), F.lit(1), approximate)


def segment(order_count: Column) -> Column:
    return (F.when(order_count >= 10, "VIP").when(order_count >= 5, "Loyal")
            .when(order_count >= 2, "Returning").otherwise("New"))


def customer_metrics(customers: DataFrame, orders: DataFrame, as_of=None) -> DataFrame:
    """Lifetime value per customer with at least one paid order."""
    total = money_sum(F.col("total_amount"))
    per_customer = paid(orders).groupBy("customer_id").agg(
        total.cast("double").alias("total_spent"),
        F.count("order_id").alias("order_count"),
        _mean(total, F.count(money(F.col("total_amount")))).alias("avg_order_value"),
        F.min("ordered_at").alias("first_order_date"),
        F.max("ordered_at").alias("last_order_date"),
    )
    return customers.select("customer_id", "first_name", "last_name", "country").join(
        per_customer, "customer_id").select(
        "customer_id", "first_name", "last_name", "country", "total_spent", "order_count",
        "avg_order_value", "first_order_date", "last_order_date",
        F.date_diff(day(as_of), F.to_date("last_order_date")).alias("days_since_last_order"),
        segment(F.col("order_count")).alias("customer_segment"),
    )


def customer_segments(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers and revenue per segment."""
    return customer_metrics(customers, orders).groupBy("customer_segment").agg(
        F.count("*").alias("customers"), money_sum(F.col("total_spent")).cast("double").alias("total_spent"))


def _product_children(products: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    sold = items.groupBy("product_id").agg(
        money_sum(F.col("total_price")).alias("revenue"),
        F.sum("quantity").alias("units"),
        F.count_distinct("order_id").alias("orders"),
    )
    rated = reviews.groupBy("product_id").agg(
        F.avg("rating").alias("avg_rating"),
        F.count_distinct("review_id").alias("reviews"),
        F.count("*").cast("int").alias("review_rows"),
    )
    return products.select("product_id", F.col("name").alias("product_name"), "category").join(
        sold, "product_id", "left").join(rated, "product_id", "left")


def _product_metrics(children: DataFrame, times: Column) -> DataFrame:
    return children.select(
        "product_id", "product_name", "category",
        F.coalesce((F.col("revenue") * times).cast("double"), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(F.col("units") * times, F.lit(0)).alias("units_sold"),
        F.coalesce("orders", F.lit(0)).alias("order_count"),
        "avg_rating",
        F.coalesce("reviews", F.lit(0)).alias("review_count"),
    )


def product_metrics(products: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Sales and rating per product with the joins the store uses: sales repeat once per review."""
    times = F.greatest(F.coalesce("review_rows", F.lit(1)), F.lit(1))
    return _product_metrics(_product_children(products, items, reviews), times)


def product_metrics_exact(products: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """The same products with each sale counted once."""
    return _product_metrics(_product_children(products, items, reviews), F.lit(1))


# Column, event type, and the name of the rate from the stage before (None: no rate).
FUNNEL = (("page_views", "page_view", None), ("product_views", "product_view", None),
          ("add_to_cart", "add_to_cart", "view_to_cart_rate"),
          ("checkout_started", "checkout_start", "cart_to_checkout_rate"),
          ("orders_completed", "purchase", "checkout_to_purchase_rate"))


def type_counts(types) -> list[Column]:
    """Aggregates counting events of each (column, event type)."""
    return [F.count_if(F.col("event_type") == kind).alias(name) for name, kind in types]


def funnel(grouped: GroupedData, stages=FUNNEL) -> DataFrame:
    """Counts per stage of grouped events, then the rates between neighbouring stages."""
    counts = grouped.agg(*type_counts([s[:2] for s in stages]))
    rates = [ratio(F.col(here[0]), F.col(before[0])).alias(here[2])
             for before, here in zip(stages, stages[1:]) if here[2]]
    return counts.select("*", *rates)


def conversion_funnel(events: DataFrame, stages=FUNNEL) -> DataFrame:
    """Events per funnel stage and day, with the rate from each stage to the next."""
    return funnel(events.groupBy(F.to_date("event_timestamp").alias("date")), stages)


def monthly_kpis(orders: DataFrame, month_as_date: bool = False, approximate: bool = False) -> DataFrame:
    month = F.date_trunc("MONTH", "ordered_at")
    total = money_sum(F.col("total_amount"))
    return paid(orders).groupBy((F.to_date(month) if month_as_date else month).alias("month")).agg(
        total.cast("double").alias("total_revenue"),
        F.count("order_id").alias("order_count"),
        _distinct("customer_id", approximate).alias("active_customers"),
        _mean(total, F.count(money(F.col("total_amount")))).alias("avg_order_value"),
    )


def monthly_kpis_full(orders: DataFrame) -> DataFrame:
    """Monthly KPIs plus new and returning customers.

    A customer's first order may have any status. One row per customer and month
    is enough for all figures, so orders are read and shuffled once.
    """
    is_paid = F.col("status").isin(*PAID_STATUSES)
    amount = money(F.col("total_amount"))
    per_month = orders.groupBy("customer_id", F.date_trunc("MONTH", "ordered_at").alias("month")).agg(
        F.sum(F.when(is_paid, amount)).alias("revenue"),
        F.count_if(is_paid).alias("orders"),
        F.count(F.when(is_paid, amount)).alias("amounts"),
        F.min("ordered_at").alias("first_at"),
    )
    of_customer = Window.partitionBy("customer_id")
    first_month = F.date_trunc("MONTH", F.min("first_at").over(of_customer))
    known = per_month.withColumn("first_month", F.when(F.col("customer_id").isNotNull(), first_month))
    total = F.sum("revenue")
    return known.where("orders > 0").groupBy("month").agg(
        total.cast("double").alias("total_revenue"),
        F.sum("orders").alias("order_count"),
        F.count("customer_id").alias("active_customers"),
        F.count_if(F.col("month") == F.col("first_month")).alias("new_customers"),
        F.count_if(F.col("month") > F.col("first_month")).alias("returning_customers"),
        _mean(total, F.sum("amounts")).alias("avg_order_value"),
    ).withColumns({"conversion_rate": F.lit(None).cast("double"),
                   "cart_abandonment_rate": F.lit(None).cast("double")})


def monthly_rates(events: DataFrame) -> DataFrame:
    """Purchases per page view, and the share of cart sessions that did not buy."""
    kind = F.col("event_type")
    per_session = events.groupBy(F.date_trunc("MONTH", "event_timestamp").alias("month"), "session_id").agg(
        F.count_if(kind == "page_view").alias("views"),
        F.count_if(kind == "purchase").alias("purchases"),
        F.count_if(kind == "add_to_cart").alias("carts"),
    )
    has_cart = F.col("carts") > 0
    return per_session.groupBy("month").agg(
        ratio(F.sum("purchases"), F.sum("views")).alias("conversion_rate"),
        (F.lit(1.0) - ratio(F.count_if(has_cart & (F.col("purchases") > 0)), F.count_if(has_cart))).alias(
            "cart_abandonment_rate"),
    )


def top_products_by_category(products: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """The ``n`` best sellers of each category by revenue."""
    sold = items.groupBy("product_id").agg(
        money_sum(F.col("total_price")).alias("revenue"), F.sum("quantity").alias("units_sold"))
    named = products.select("product_id", F.col("name").alias("product_name"), "category").join(sold, "product_id")
    best = Window.partitionBy("category").orderBy(F.desc("revenue"), F.asc("product_id"))
    return named.withColumn("rank_in_category", F.row_number().over(best)).where(
        F.col("rank_in_category") <= n).select(
        "category", "product_id", "product_name", F.col("revenue").cast("double").alias("total_revenue"),
        "units_sold", "rank_in_category")


def product_return_rate(items: DataFrame, payments: DataFrame) -> DataFrame:
    """Share of a product's orders that had a refunded payment."""
    bought = items.select("product_id", "order_id").where("order_id is not null").distinct()
    refunded = payments.where("status = 'refunded'").select("order_id").distinct().withColumn("_back", F.lit(1))
    return bought.join(refunded, "order_id", "left").groupBy("product_id").agg(
        F.count("*").alias("order_count"), F.count("_back").alias("returned_orders"),
    ).withColumn("return_rate", ratio(F.col("returned_orders"), F.col("order_count")))


def low_stock(inventory: DataFrame, threshold: int) -> DataFrame:
    """Product and warehouse pairs, and whole products, with fewer than ``threshold`` units free."""
    free = F.col("quantity_available") - F.col("quantity_reserved")
    per_warehouse = inventory.select("product_id", "warehouse", free.alias("free_units"))
    per_product = per_warehouse.groupBy("product_id").agg(
        F.lit(None).cast("string").alias("warehouse"), F.sum("free_units").alias("free_units"))
    return per_warehouse.withColumn("level", F.lit("warehouse")).unionByName(
        per_product.withColumn("level", F.lit("product"))).where(F.col("free_units") < threshold)


def payment_summary(payments: DataFrame) -> DataFrame:
    """Paid, failed and refunded amounts per day and method."""
    def amount(status: str) -> Column:
        found = F.when(F.col("status") == status, money(F.col("amount")))
        return F.coalesce(F.sum(found).cast("double"), F.lit(0.0))

    return payments.groupBy(F.to_date("paid_at").alias("date"), "payment_method").agg(
        F.count("*").alias("payments"),
        amount("completed").alias("paid_amount"),
        amount("failed").alias("failed_amount"),
        amount("refunded").alias("refunded_amount"),
    )


def traffic_stats(events: DataFrame) -> DataFrame:
    """Totals per event type and the two headline rates in percent, over all events."""
    counts = events.agg(F.count("*").alias("total"), *type_counts([(t, t) for t in EVENT_TYPES]))
    return counts.select(
        "*",
        (ratio(F.col("add_to_cart"), F.col("product_view")) * 100).alias("view_to_cart_pct"),
        (ratio(F.col("purchase"), F.col("checkout_start")) * 100).alias("checkout_to_buy_pct"),
    )


def event_type_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("total")).orderBy(
        F.desc("total"), F.asc("event_type"))


def enrich_events(events: DataFrame, products: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Events with the product (and customer) they name.

    No broadcast hint: the planner broadcasts a side whose size allows it, and
    splits a hot product's rows over several tasks where it cannot.
    """
    shown = products.select("product_id", F.col("name").alias("product_name"), "category", "price")
    out = events.join(shown, "product_id", "left")
    if customers is not None:
        out = out.join(customers.select("customer_id", "first_name", "country"), "customer_id", "left")
    return out


# ---- serving

VIEWS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "daily_revenue": (daily_revenue, ("orders", "order_items")),
    "customer_metrics": (customer_metrics, ("customers", "orders")),
    "product_metrics": (product_metrics, ("products", "order_items", "reviews")),
    "conversion_funnel": (conversion_funnel, ("events",)),
    "monthly_kpis": (monthly_kpis, ("orders",)),
}

# Views grouped by a time, and the table whose day partitions carry it.
DATED = {"daily_revenue": "orders", "conversion_funnel": "events", "monthly_kpis": "orders"}


def view(lake: Lakehouse, name: str, days: tuple[str, str] | None = None, **options) -> DataFrame:
    """A Gold view. ``days`` (first, last) limits a dated view, and its scan, to those days' partitions."""
    make, inputs = VIEWS[name]
    if days is not None and name not in DATED:
        raise ValueError(f"{name} is not a view by date")
    frames = [lake.silver(t).read(*(days or ()) if t == DATED.get(name) else ()) for t in inputs]
    return partial(make, **options)(*frames)


def register_views(lake: Lakehouse) -> list[str]:
    """Register the five Gold views; rerun after a merge to see its rows."""
    for name in VIEWS:
        view(lake, name).createOrReplaceTempView(f"gold_{name}")
    return [f"gold_{n}" for n in VIEWS]


def materialize(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Store a Gold result; a rerun replaces the partitions it brings instead of doubling them."""
    writer = df.write.mode("overwrite")
    if partition:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition)
    writer.parquet(path)
