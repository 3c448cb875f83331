"""The benchmark tables in the roles of the store's Silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared, so that zone-less file timestamps read as instants and filters on them reach the scan.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp",
    "events": "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "conversations": "conv_id long, turn long, role string, text string",
}
EVENT_ROLES = {"view": "page_view", "click": "product_view", "signup": "add_to_cart",
               "error": "checkout_start", "purchase": "purchase"}


def choose(column: Column, mapping: dict[str, str], other: str) -> Column:
    cases = F
    for key, value in mapping.items():
        cases = cases.when(column == key, value)
    return cases.otherwise(other)


class Store:
    """Silver-shaped frames over one benchmark folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))

    def orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
            choose(F.col("o_orderstatus"), {"F": "completed", "O": "delivered"}, "pending").alias("status"),
            F.col("o_totalprice").alias("total_amount"), F.lit("USD").alias("currency"),
            F.col("o_orderdate").alias("ordered_at"), F.lit(None).cast("timestamp").alias("shipped_at"))

    def order_items(self) -> DataFrame:
        return self.table("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
            F.col("l_extendedprice").alias("total_price"), F.col("l_discount").alias("discount"))

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
            F.col("p_type").alias("category"), F.col("p_brand").alias("subcategory"),
            F.col("p_retailprice").alias("price"))

    def customers(self) -> DataFrame:
        named = self.table("customer").join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        first, last = F.split_part("c_name", F.lit("#"), F.lit(1)), F.split_part("c_name", F.lit("#"), F.lit(2))
        return named.select(
            F.col("c_custkey").alias("customer_id"),
            F.concat(F.lower(first), F.lit("."), last, F.lit("@example.com")).alias("email"),
            first.alias("first_name"), last.alias("last_name"),
            F.concat(F.lit("+1"), last).alias("phone"),
            F.col("n_name").alias("country"), F.col("r_name").alias("city"),
            F.concat(F.col("c_mktsegment"), F.lit(" street")).alias("address"))

    def payments(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("payment_id"), F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("amount"),
            F.col("o_orderpriority").alias("payment_method"),
            choose(F.col("o_orderstatus"), {"F": "completed", "O": "failed"}, "refunded").alias("status"),
            F.col("o_orderdate").alias("paid_at"))

    def inventory(self) -> DataFrame:
        return self.table("lineitem").groupBy(
            F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("warehouse")).agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity_available"),
            F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("bigint")).otherwise(0)).alias(
                "quantity_reserved"))

    def reviews(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("review_id"), F.col("user_id").alias("product_id"),
            F.col("user_id").alias("customer_id"), (F.col("event_id") % 5 + 1).alias("rating"),
            F.col("ts").alias("created_at"))

    def events(self) -> DataFrame:
        return silver_events(self.table("events"))


def silver_events(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", choose(F.col("event_type"), EVENT_ROLES, "search").alias("event_type"),
        F.col("user_id").alias("customer_id"),
        F.concat_ws("-", F.col("user_id"), F.to_date("ts")).alias("session_id"),
        F.col("user_id").alias("product_id"), F.col("ts").alias("event_timestamp"), "value")


# The same roles for the SQL side, as WITH entries.
SQL_ROLES = {
    "s_orders": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'delivered' ELSE 'pending' END AS status,
        o_totalprice AS total_amount, 'USD' AS currency, o_orderdate AS ordered_at FROM orders""",
    "s_items": """SELECT l_orderkey || '-' || l_linenumber AS order_item_id, l_orderkey AS order_id,
        l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
        l_extendedprice / l_quantity AS unit_price, l_extendedprice AS total_price, l_discount AS discount
        FROM lineitem""",
    "s_products": """SELECT p_partkey AS product_id, p_name AS name, p_type AS category,
        p_retailprice AS price FROM part""",
    "s_customers": """SELECT c_custkey AS customer_id,
        lower(split_part(c_name, '#', 1)) || '.' || split_part(c_name, '#', 2) || '@example.com' AS email,
        split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
        '+1' || split_part(c_name, '#', 2) AS phone, n_name AS country, r_name AS city,
        c_mktsegment || ' street' AS address
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
    "s_payments": """SELECT o_orderkey AS payment_id, o_orderkey AS order_id, o_custkey AS customer_id,
        o_totalprice AS amount, o_orderpriority AS payment_method,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'failed' ELSE 'refunded' END AS status,
        o_orderdate AS paid_at FROM orders""",
    "s_inventory": """SELECT l_partkey AS product_id, l_suppkey AS warehouse,
        CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity_available,
        CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT)
        AS quantity_reserved FROM lineitem GROUP BY 1, 2""",
    "s_reviews": """SELECT event_id AS review_id, user_id AS product_id, event_id % 5 + 1 AS rating FROM events""",
    "s_events": """SELECT event_id, CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'product_view'
        WHEN 'signup' THEN 'add_to_cart' WHEN 'error' THEN 'checkout_start' WHEN 'purchase' THEN 'purchase'
        ELSE 'search' END AS event_type, user_id AS customer_id,
        user_id || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id, user_id AS product_id,
        ts AS event_timestamp, value FROM events""",
}


def with_roles(sql: str, *roles: str) -> str:
    """Put the roles a statement uses in front of it."""
    entries = ", ".join(f"{r} AS ({SQL_ROLES[r]})" for r in roles)
    rest = sql.strip()
    if rest.upper().startswith("WITH "):
        return f"WITH {entries}, {rest[5:]}"
    return f"WITH {entries} {rest}"
