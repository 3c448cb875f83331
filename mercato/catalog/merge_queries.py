"""Ingest, parse and merge over the benchmark tables.

Each merge loads two batches as raw JSON rows: an earlier delivery, and a later
one with the whole table. The later batch also carries the earlier rows, as every
run reads all of Bronze.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.catalog import gold_queries  # noqa: F401  (its SQL is reused below)
from mercato.catalog.registry import ORACLES, query
from mercato.catalog.roles import Store, choose, silver_events, with_roles
from mercato.lakehouse import Lakehouse
from mercato.operators import ingest, merge
from mercato.plans import gold, medallion
from mercato.schemas import ENTITIES
from mercato.session import scratch_path
from mercato.sources import csv_files

FIRST_LOAD, SECOND_LOAD = "2024-02-01 00:00:00", "2024-02-02 00:00:00"


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def raw(entity: str, rows: DataFrame, loaded: str, *columns: Column, source: Column | None = None,
        at: Column | None = None) -> DataFrame:
    """Bronze rows of an entity from expressions named like its JSON fields."""
    kept = rows.select(*columns, (source if source is not None else F.lit(f"gcs/{entity}/{loaded[:10]}.csv")).alias(
        "_source"), (at if at is not None else F.lit(loaded).cast("timestamp")).alias("_at"))
    fields = [c for c in kept.columns if not c.startswith("_")]
    doc = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in fields]), {"ignoreNullFields": "false"})
    lineage = [F.col("_source").alias("source"), F.col("_at").alias("ingested_at")]
    if ENTITIES[entity].carried:
        return kept.select(F.col("event_id").cast("string").alias("event_id"), "event_type",
                           doc.alias("raw_payload"), *lineage)
    return kept.select(F.col(fields[0]).cast("string").alias("record_id"), doc.alias("raw_data"), *lineage)


def two_loads(entity: str, first: DataFrame, second: DataFrame) -> DataFrame:
    """Silver after a first load and a merge of everything delivered by then."""
    spec = ENTITIES[entity]
    before = merge.batch(first, spec, FIRST_LOAD)
    arriving = merge.batch(first.unionByName(second), spec, SECOND_LOAD)
    return merge.merged(before, arriving, spec).drop("processed_at")


def named(**columns: Column) -> list[Column]:
    return [value.alias(name) for name, value in columns.items()]


_KEYED_NAME = "'cust-' || lpad(CAST(c_custkey AS VARCHAR), 9, '0')"


@query("merge_customers", f"""
    WITH c AS (SELECT *, c_mktsegment IN ('BUILDING', 'MACHINERY') AS known FROM customer
      LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)
    SELECT {_KEYED_NAME} AS customer_id, lower(replace(c_name, '#', '.')) || '@example.com' AS email,
      split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
      '+1' || split_part(c_name, '#', 2) AS phone, n_name AS country, r_name AS city,
      c_mktsegment || ' street' AS address,
      CASE WHEN known THEN TIMESTAMP '2019-03-01 08:00:00' ELSE TIMESTAMP '2020-05-01 09:30:00' END AS created_at,
      TIMESTAMP '2024-01-05 10:00:00' AS updated_at FROM c""")
def merge_customers(s: Store):
    rows = s.table("customer").join(s.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(
        s.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")

    def load(df: DataFrame, when: str, domain: str, address: Column, created: str, updated: str) -> DataFrame:
        last = F.split_part("c_name", F.lit("#"), F.lit(2))
        return raw("customers", df, when, *named(
            id=F.concat(F.lit("cust-"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")),
            email=F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit(domain)),
            first_name=F.split_part("c_name", F.lit("#"), F.lit(1)), last_name=last,
            phone=F.concat(F.lit("+1"), last), country=F.col("n_name"), city=F.col("r_name"), address=address,
            created_at=F.lit(created), updated_at=F.lit(updated)))

    first = load(rows.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")), FIRST_LOAD, "@old.example.com",
                 F.lit("unknown"), "2019-03-01T08:00:00Z", "2019-03-01T08:00:00Z")
    second = load(rows, SECOND_LOAD, "@example.com", F.concat("c_mktsegment", F.lit(" street")),
                  "2020-05-01T09:30:00Z", "2024-01-05T10:00:00+00:00")
    return two_loads("customers", first, second)


@query("merge_products", """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_name || ' / new' AS description,
      CASE WHEN p_size <= 25 THEN p_type ELSE 'NEW ' || p_type END AS category, p_brand AS subcategory,
      p_retailprice AS price, 'USD' AS currency,
      CASE WHEN p_size <= 25 THEN 'A-' || p_partkey ELSE 'B-' || p_partkey END AS sku,
      p_size > 10 AS is_active, CAST(NULL AS TIMESTAMP) AS created_at FROM part""")
def merge_products(s: Store):
    def load(df: DataFrame, when: str, tag: str, category: Column, price: Column, active: Column, sku: str):
        return raw("products", df, when, *named(
            id=F.col("p_partkey"), name=F.col("p_name"), description=F.concat("p_name", F.lit(tag)),
            category=category, subcategory=F.col("p_brand"), price=price, currency=F.lit("USD"),
            sku=F.concat(F.lit(sku), F.col("p_partkey")), is_active=active, created_at=F.lit("")))

    parts = s.table("part")
    first = load(parts.where("p_size <= 25"), FIRST_LOAD, " / old", F.col("p_type"), F.lit("n/a"),
                 F.lit("yes"), "A-")
    second = load(parts, SECOND_LOAD, " / new", F.concat(F.lit("NEW "), F.col("p_type")), F.col("p_retailprice"),
                  F.when(F.col("p_size") > 10, "TRUE").otherwise("false"), "B-")
    return two_loads("products", first, second)


@query("merge_orders", """
    WITH o AS (SELECT *, o_orderdate < TIMESTAMP '1998-01-01' AS known FROM orders)
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
      CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'delivered' ELSE 'cancelled' END AS status,
      CASE WHEN known THEN o_totalprice ELSE -1.0 END AS total_amount, 'USD' AS currency,
      CASE WHEN known THEN 'dock 1' ELSE 'dock 2' END AS shipping_address, '' AS shipping_city,
      'C' || (o_custkey % 7) AS shipping_country, o_orderdate AS ordered_at,
      CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 2 DAY END AS shipped_at,
      CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 5 DAY END AS delivered_at FROM o""")
def merge_orders(s: Store):
    at = F.col("o_orderdate")

    def load(df: DataFrame, when: str, status: Column, amount: Column, dock: str, shipped: Column, delivered: Column):
        return raw("orders", df, when, *named(
            order_id=F.col("o_orderkey"), customer_id=F.col("o_custkey"), status=status, total_amount=amount,
            currency=F.lit("USD"), shipping_address=F.lit(dock), shipping_city=F.lit(""),
            shipping_country=F.concat(F.lit("C"), F.col("o_custkey") % 7), ordered_at=iso(at),
            shipped_at=shipped, delivered_at=delivered))

    orders, state = s.table("orders"), F.col("o_orderstatus")
    first = load(orders.where(at < F.lit("1998-01-01").cast("timestamp")), FIRST_LOAD, F.lit("processing"),
                 F.col("o_totalprice"), "dock 1", iso(at), F.lit(""))
    second = load(orders, SECOND_LOAD, choose(state, {"F": "completed", "O": "delivered"}, "cancelled"), F.lit("-1"),
                  "dock 2", F.when(state != "P", iso(at + F.expr("interval 2 days"))).otherwise(""),
                  F.when(state == "O", iso(at + F.expr("interval 5 days"))).otherwise(""))
    return two_loads("orders", first, second)


@query("merge_events", with_roles("""
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(customer_id AS VARCHAR) AS customer_id, session_id,
      CAST(product_id AS VARCHAR) AS product_id, '' AS search_query, '/home' AS page_url,
      CASE WHEN event_timestamp < TIMESTAMP '2024-01-16' THEN 'mobile' ELSE 'desktop' END AS device,
      event_timestamp FROM s_events""", "s_events"))
def merge_events(s: Store):
    def load(df: DataFrame, when: str, device: str):
        return raw("events", df, when, *named(
            event_id=F.col("event_id"), event_type=F.col("event_type"), customer_id=F.col("customer_id"),
            session_id=F.col("session_id"), product_id=F.col("product_id"), search_query=F.lit(""),
            page_url=F.lit("/home"), device=F.lit(device), timestamp=iso(F.col("event_timestamp"))))

    old = s.table("events").where(F.col("ts") < F.lit("2024-01-16").cast("timestamp"))
    return two_loads("events", load(silver_events(old), FIRST_LOAD, "mobile"), load(s.events(), SECOND_LOAD, "desktop"))


@query("merge_payments", with_roles("""
    SELECT 'pay-' || payment_id AS payment_id, CAST(order_id AS VARCHAR) AS order_id,
      CAST(customer_id AS VARCHAR) AS customer_id,
      CASE WHEN paid_at < TIMESTAMP '1998-01-01' THEN amount END AS amount, 'USD' AS currency, payment_method, status,
      paid_at FROM s_payments""", "s_payments"))
def merge_payments(s: Store):
    def load(df: DataFrame, when: str, amount: Column, status: Column):
        return raw("payments", df, when, *named(
            payment_id=F.concat(F.lit("pay-"), F.col("payment_id")), order_id=F.col("order_id"),
            customer_id=F.col("customer_id"), amount=amount, currency=F.lit("USD"),
            payment_method=F.col("payment_method"), status=status, paid_at=iso(F.col("paid_at"))))

    pays = s.payments()
    first = load(pays.where(F.col("paid_at") < F.lit("1998-01-01").cast("timestamp")), FIRST_LOAD, F.col("amount"),
                 F.lit("pending"))
    return two_loads("payments", first, load(pays, SECOND_LOAD, F.lit("12,50"), F.col("status")))


_BY_VALUES = """'supplier/' || l_suppkey DESC, CAST(l_partkey AS VARCHAR) DESC, l_quantity DESC, l_tax DESC,
    l_extendedprice DESC, l_discount DESC"""
_ITEM_PICK = f"row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {_BY_VALUES})"
_LOAD_PICK = f"row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_BY_VALUES})"


def _item_rows(df: DataFrame, at: Column | None = None) -> DataFrame:
    return raw("order_items", df, FIRST_LOAD, *named(
        order_item_id=F.concat(F.lit("oi-"), F.concat_ws("-", "l_orderkey", "l_linenumber")),
        order_id=F.col("l_orderkey"), product_id=F.col("l_partkey"), quantity=F.col("l_quantity").cast("bigint"),
        unit_price=F.col("l_tax"), total_price=F.col("l_extendedprice"), discount=F.col("l_discount")),
        source=F.concat(F.lit("supplier/"), F.col("l_suppkey")), at=at)


@query("merge_order_items", f"""
    WITH early AS (SELECT *, {_ITEM_PICK} AS pick FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
      late AS (SELECT *, {_ITEM_PICK} AS pick FROM lineitem),
      silver AS (SELECT * FROM early WHERE pick = 1 UNION ALL SELECT * FROM late l WHERE pick = 1 AND NOT EXISTS
        (SELECT 1 FROM early e WHERE e.l_orderkey = l.l_orderkey AND e.l_linenumber = l.l_linenumber))
    SELECT 'oi-' || l_orderkey || '-' || l_linenumber AS order_item_id, CAST(l_orderkey AS VARCHAR) AS order_id,
      CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_quantity AS BIGINT) AS quantity, l_tax AS unit_price,
      l_extendedprice AS total_price, l_discount AS discount FROM silver""")
def merge_order_items(s: Store):
    lines, spec = s.table("lineitem"), ENTITIES["order_items"]
    early = lines.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp"))
    before = merge.batch(_item_rows(early, F.col("l_shipdate")), spec, FIRST_LOAD)
    arriving = merge.batch(_item_rows(lines, F.col("l_shipdate")), spec, SECOND_LOAD)
    return merge.merged(before, arriving, spec).drop("processed_at")


@query("merge_inventory", """
    SELECT CAST(l_partkey AS VARCHAR) AS product_id, 'warehouse-' || l_suppkey AS warehouse,
      CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity_available,
      CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS quantity_reserved,
      max(l_shipdate) AS last_updated FROM lineitem GROUP BY l_partkey, l_suppkey""")
def merge_inventory(s: Store):
    def load(df: DataFrame, when: str) -> DataFrame:
        units = F.col("l_quantity").cast("bigint")
        stock = df.groupBy("l_partkey", "l_suppkey").agg(
            F.sum(units).alias("have"), F.sum(F.when(F.col("l_linestatus") == "O", units).otherwise(0)).alias("held"),
            F.max("l_shipdate").alias("at"))
        return raw("inventory", stock, when, *named(
            product_id=F.col("l_partkey"), warehouse=F.concat(F.lit("warehouse-"), F.col("l_suppkey")),
            quantity_available=F.col("have"), quantity_reserved=F.col("held"), last_updated=iso(F.col("at"))))

    lines = s.table("lineitem")
    early = lines.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp"))
    return two_loads("inventory", load(early, FIRST_LOAD), load(lines, SECOND_LOAD))


@query("merge_reviews", """
    SELECT 'rev-' || event_id AS review_id, CAST(user_id AS VARCHAR) AS product_id,
      CAST(user_id AS VARCHAR) AS customer_id,
      CASE WHEN ts < TIMESTAMP '2024-01-16' THEN event_id % 5 + 1 END AS rating, event_type AS title,
      props AS comment, ts AS created_at FROM events""")
def merge_reviews(s: Store):
    def load(df: DataFrame, when: str, rating: Column) -> DataFrame:
        return raw("reviews", df, when, *named(
            review_id=F.concat(F.lit("rev-"), F.col("event_id")), product_id=F.col("user_id"),
            customer_id=F.col("user_id"), rating=rating, title=F.col("event_type"), comment=F.col("props"),
            created_at=iso(F.col("ts"))))

    events = s.table("events")
    first = load(events.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp")), FIRST_LOAD,
                 F.col("event_id") % 5 + 1)
    return two_loads("reviews", first, load(events, SECOND_LOAD, F.lit("4.5")))


@query("insert_if_absent", """
    WITH early AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
      late AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_partkey NOT IN (SELECT l_partkey FROM early))
    SELECT CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS warehouse FROM early
    UNION ALL SELECT CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR) FROM late""")
def insert_if_absent(s: Store):
    """The older load keyed inventory by product alone: further warehouses of a known product stay out."""
    lines = s.table("lineitem")
    pairs = [F.col("l_partkey").cast("string").alias("product_id"), F.col("l_suppkey").cast("string").alias("warehouse")]
    early = lines.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp")).select(*pairs).distinct()
    return merge.insert_if_absent(early, lines.select(*pairs).distinct(), ENTITIES["inventory"], ["product_id"])


# ---- keys and duplicates


@query("latest_per_key", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS pick FROM lineitem)
    WHERE pick = 1""")
def latest_per_key(s: Store):
    lines = s.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    newest = [F.col(c).desc() for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")]
    return merge.latest_per_key(lines, ["l_orderkey", "l_linenumber"], newest)


@query("duplicate_keys", """
    SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(s: Store):
    return merge.duplicate_keys(s.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("insert_not_in", "SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def insert_not_in(s: Store):
    return merge.not_in(s.table("orders"), "o_orderkey", s.table("lineitem"), "l_orderkey")


# ---- files, parsing, ranges


@query("csv_to_bronze", with_roles("""
    SELECT 'customers_raw' AS table_name, CAST(customer_id AS VARCHAR) AS record_id, email AS label,
      address AS detail FROM s_customers
    UNION ALL SELECT 'products_raw', CAST(product_id AS VARCHAR), name, '"' || category || '", ' || chr(10) || 'new'
    FROM s_products""", "s_customers", "s_products"))
def csv_to_bronze(s: Store):
    """Write the tables as CSV into a landing folder, then load that folder."""
    landing = scratch_path(s.spark, "landing")
    blank = F.lit("")
    customers = s.customers().select(*named(
        id=F.col("customer_id").cast("string"), email=F.col("email"), first_name=F.col("first_name"),
        last_name=F.col("last_name"), phone=F.col("phone"), country=F.col("country"), city=F.col("city"),
        address=F.col("address"), created_at=blank, updated_at=blank))
    products = s.products().select(*named(
        id=F.col("product_id").cast("string"), name=F.col("name"),
        description=F.concat(F.lit('"'), F.col("category"), F.lit('", \nnew')), category=F.col("category"),
        subcategory=F.col("subcategory"), price=F.col("price").cast("string"), currency=F.lit("USD"), sku=blank,
        is_active=F.lit("true"), created_at=blank))
    for name, df in (("customers", customers), ("products", products), ("suppliers", customers)):
        df.write.option("header", "true").option("escape", '"').option("quoteAll", "true").csv(f"{landing}/{name}")
    out = None
    for entity, label, detail in (("customers", "email", "address"), ("products", "name", "description")):
        rows = csv_files.bronze_from_folder(s.spark, landing, entity)
        doc = F.from_json("raw_data", f"{label} string, {detail} string")
        shown = csv_files.route_by_folder(
            rows.withColumn("name", F.regexp_replace("source", "^gcs/", "")), "name").select(
            "table_name", "record_id", doc[label].alias("label"), doc[detail].alias("detail"))
        out = shown if out is None else out.unionByName(shown)
    return out


@query("parse_bronze", """
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
      CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
      '{' || o_orderstatus AS status, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS total_amount,
      CAST(NULL AS VARCHAR) AS currency, CAST(NULL AS VARCHAR) AS shipping_address, 'true' AS shipping_city,
      CAST(o_custkey AS VARCHAR) AS shipping_country, o_orderdate AS ordered_at,
      CAST(NULL AS TIMESTAMP) AS shipped_at, CAST(NULL AS TIMESTAMP) AS delivered_at FROM orders""")
def parse_bronze(s: Store):
    """Typed columns from JSON with nested, missing, numeric and malformed fields."""
    c = F.col
    nested = F.when(c("o_orderpriority") == "5-LOW", F.lit('{"id":1}')).otherwise(
        F.concat(F.lit('"'), c("o_custkey"), F.lit('"')))
    amount = F.when(c("o_orderstatus") == "P", F.lit('"12d"')).otherwise(c("o_totalprice").cast("string"))
    doc = F.concat(
        F.lit('{"order_id":"'), c("o_orderkey"), F.lit('","customer_id":'), nested,
        F.lit(',"status":"{'), c("o_orderstatus"), F.lit('","total_amount":'), amount,
        F.lit(',"currency":null,"shipping_address":["dock"],"shipping_city":true,"shipping_country":'),
        c("o_custkey"), F.lit(',"ordered_at":"'), iso(c("o_orderdate")),
        F.lit('","shipped_at":"","delivered_at":"2026"}'))
    bronze = s.table("orders").select(doc.alias("raw_data"))
    return merge.parse_bronze(bronze, ENTITIES["orders"], FIRST_LOAD).drop("processed_at")


@query("decode_notifications", """
    SELECT doc_id, 'store-' || lang AS bucket, path AS name, n_chars AS size, 'text/csv' AS content_type,
      split_part(path, '/', 1) AS folder,
      CASE WHEN path LIKE '%.csv' AND split_part(path, '/', 1) IN ('customers', 'orders', 'events')
        THEN split_part(path, '/', 1) || '_raw' END AS table_name
    FROM (SELECT *, CASE source WHEN 'src0' THEN 'customers' WHEN 'src1' THEN 'orders' WHEN 'src2' THEN 'events'
        ELSE source END || '/' || doc_id || CASE WHEN n_chars > 500 THEN '.csv' ELSE '.keep' END AS path
      FROM documents)""")
def decode_notifications(s: Store):
    folder = F.when(F.col("source") == "src0", "customers").when(F.col("source") == "src1", "orders").when(
        F.col("source") == "src2", "events").otherwise(F.col("source"))
    ending = F.when(F.col("n_chars") > 500, ".csv").otherwise(".keep")
    notice = F.to_json(F.struct(
        F.concat(F.lit("store-"), F.col("lang")).alias("bucket"),
        F.concat(folder, F.lit("/"), F.col("doc_id"), ending).alias("name"),
        F.col("n_chars").cast("string").alias("size"), F.lit("text/csv").alias("contentType")))
    messages = s.table("documents").select("doc_id", F.base64(notice.cast("binary")).alias("data"))
    return csv_files.decode_notifications(messages).drop("data")


@query("reprocess_range", with_roles("""
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, session_id, event_timestamp FROM s_events
    WHERE CAST(event_timestamp AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""", "s_events"))
def reprocess_range(s: Store):
    """Bronze events of three days, parsed again."""
    days = silver_events(ingest.reprocess_range(s.table("events"), "2024-01-10", "2024-01-12", "ts"))
    bronze = raw("events", days, FIRST_LOAD, *named(
        event_id=F.col("event_id"), event_type=F.col("event_type"), session_id=F.col("session_id"),
        timestamp=iso(F.col("event_timestamp"))), at=F.col("event_timestamp"))
    return merge.parse_bronze(bronze, ENTITIES["events"]).select(
        "event_id", "event_type", "session_id", "event_timestamp")


@query("orders_on_date", """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS total_amount, o_orderdate AS ordered_at
    FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1997-05-28'""")
def orders_on_date(s: Store):
    day = ingest.reprocess_range(s.orders(), "1997-05-28", "1997-05-28", "ordered_at")
    return day.select("order_id", "customer_id", "total_amount", "ordered_at")


@query("medallion_products", f"""
    WITH items AS (SELECT * FROM (SELECT *, {_LOAD_PICK} AS pick FROM lineitem) WHERE pick = 1),
      sold AS (SELECT l_partkey, sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS revenue,
        sum(CAST(l_quantity AS BIGINT)) AS units, count(DISTINCT l_orderkey) AS orders FROM items GROUP BY 1),
      rated AS (SELECT user_id, avg(event_id % 5 + 1) AS avg_rating, count(*) AS n FROM events GROUP BY 1)
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
      coalesce(CAST(revenue * greatest(coalesce(n, 1), 1) AS DOUBLE), 0.0) AS total_revenue,
      CAST(coalesce(units * greatest(coalesce(n, 1), 1), 0) AS BIGINT) AS units_sold, coalesce(orders, 0) AS order_count,
      avg_rating, coalesce(n, 0) AS review_count
    FROM part LEFT JOIN sold ON p_partkey = l_partkey LEFT JOIN rated ON p_partkey = user_id""")
def medallion_products(s: Store):
    """Three entities through a lakehouse: Bronze rows, the merge run, the Gold view."""
    lake = Lakehouse(s.spark, scratch_path(s.spark, "lake")).create()
    c = F.col
    lake.bronze("products_raw").append(raw("products", s.table("part"), FIRST_LOAD, *named(
        id=c("p_partkey"), name=c("p_name"), category=c("p_type"), price=c("p_retailprice"))), one_day=True)
    lake.bronze("order_items_raw").append(_item_rows(s.table("lineitem")), one_day=True)
    lake.bronze("reviews_raw").append(raw("reviews", s.reviews(), FIRST_LOAD, *named(
        review_id=c("review_id"), product_id=c("product_id"), rating=c("rating"), created_at=iso(c("created_at")))),
        one_day=True)
    medallion.bronze_to_silver(lake, ["products", "order_items", "reviews"], now=SECOND_LOAD)
    return gold.view(lake, "product_metrics")


@query("medallion_funnel", ORACLES["conversion_funnel"])
def medallion_funnel(s: Store):
    """Events through a lakehouse of their own: Bronze rows, merge, Gold view."""
    lake = Lakehouse(s.spark, scratch_path(s.spark, "lake")).create()
    at = F.col("event_timestamp")
    lake.bronze("events_raw").append(raw("events", s.events(), FIRST_LOAD, *named(
        event_id=F.col("event_id"), event_type=F.col("event_type"), customer_id=F.col("customer_id"),
        session_id=F.col("session_id"), product_id=F.col("product_id"), timestamp=iso(at)), at=at))
    merge.merge_into(lake, "events", now=SECOND_LOAD)
    return gold.view(lake, "conversion_funnel")
