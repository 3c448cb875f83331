"""Personal data, access, retention, counts and quality over the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.catalog.registry import query
from mercato.catalog.roles import Store, with_roles
from mercato.functions import pii
from mercato.lakehouse import Table
from mercato.operators import checks, governance, ingest, privacy
from mercato.plans import gold
from mercato.schemas import ENTITIES
from mercato.session import scratch_path

TOKEN_KEY = "0123456789abcdef"  # test key of the benchmark run; a real one is passed in by the caller


def _found(text: str, context: bool = False) -> str:
    """Findings of a (doc_id, text) relation, one row per match."""
    lead = f"(?:{pii.CONTEXT})?" if context else ""
    parts = [f"SELECT doc_id, '{t}' AS info_type, unnest(regexp_extract_all(text, '{lead}{p}')) AS value FROM {text}"
             for t, p in pii.PATTERNS.items()]
    return " UNION ALL ".join(parts)


def _masked(value: str, info_type: str) -> str:
    if info_type == "EMAIL_ADDRESS":
        domain = f"split_part({value}, '@', 2)"
        ending = f"split_part({domain}, '.', -1)"
        return (f"left({value}, 1) || repeat('*', strpos({value}, '@') - 2) || '@' || regexp_replace(left({domain}, "
                f"length({domain}) - length({ending}) - 1), '[^.]', '*', 'g') || '.' || {ending}")
    if info_type == "IP_ADDRESS":
        return f"regexp_replace({value}, '[0-9]+$', '0/24')"
    keep = 1 if info_type == "PHONE_NUMBER" else 4
    return f"regexp_replace(left({value}, length({value}) - {keep}), '[0-9]', '*', 'g') || right({value}, {keep})"


def _protected() -> str:
    """Documents with one type after the other replaced, as WITH entries d0 (raw) to d4."""
    steps = ["d0 AS (SELECT doc_id, text FROM documents)"]
    for n, (t, p) in enumerate(pii.PATTERNS.items(), 1):
        pieces = f"string_split_regex(text, '{p}')"
        hidden = f"list_transform(regexp_extract_all(text, '{p}'), lambda v: {_masked('v', t)})"
        steps.append(f"d{n} AS (SELECT doc_id, array_to_string(list_transform(list_zip({pieces}, {hidden}), "
                     f"lambda z: z[1] || coalesce(z[2], '')), '') AS text FROM d{n - 1})")
    return ", ".join(steps)


@query("pii_inspect", f"""
    WITH f AS ({_found('documents')}), per_row AS (SELECT info_type, doc_id, count(*) AS n FROM f GROUP BY 1, 2)
    SELECT info_type, CAST(sum(n) AS BIGINT) AS findings, count(*) AS rows_with_pii FROM per_row GROUP BY 1""")
def pii_inspect(s: Store):
    return privacy.inspect(s.table("documents"), "doc_id", "text")


_LUHN = """list_sum(list_transform(list_zip(string_split(reverse(regexp_replace(value, '[^0-9]', '', 'g')), ''),
    range(16)), lambda z: CASE WHEN z[2] % 2 = 0 THEN CAST(z[1] AS INTEGER)
    WHEN CAST(z[1] AS INTEGER) > 4 THEN CAST(z[1] AS INTEGER) * 2 - 9 ELSE CAST(z[1] AS INTEGER) * 2 END)) % 10 = 0"""


@query("pii_likelihood", f"""
    WITH f AS ({_found('documents', True)}),
      g AS (SELECT doc_id, info_type, regexp_replace(value, '^{pii.CONTEXT}', '') AS value,
        regexp_matches(value, '^{pii.CONTEXT}') AS has_context FROM f),
      rated AS (SELECT doc_id, info_type, value, CASE
        WHEN info_type = 'IP_ADDRESS' AND list_max(list_transform(string_split(
          CASE WHEN info_type = 'IP_ADDRESS' THEN value ELSE '0' END, '.'), lambda o: CAST(o AS INTEGER))) > 255
          THEN 'POSSIBLE'
        WHEN has_context THEN 'VERY_LIKELY'
        WHEN info_type = 'CREDIT_CARD_NUMBER' AND (CASE WHEN info_type = 'CREDIT_CARD_NUMBER' THEN {_LUHN}
          ELSE false END) THEN 'VERY_LIKELY'
        WHEN info_type = 'PHONE_NUMBER' AND NOT starts_with(value, '+') THEN 'POSSIBLE'
        ELSE 'LIKELY' END AS likelihood FROM g)
    SELECT * FROM rated WHERE likelihood <> 'POSSIBLE'""")
def pii_likelihood(s: Store):
    return privacy.rate_findings(s.table("documents"), "doc_id", "text")


@query("mask_pii", f"WITH {_protected()} SELECT doc_id, text FROM d{len(pii.PATTERNS)}")
def mask_pii(s: Store):
    """Every document, whole, with what was found in it masked or generalised."""
    return privacy.protect_texts(s.table("documents").select("doc_id", "text"), "text")


@query("pii_residual", f"""
    WITH {_protected()}, f AS ({_found(f'd{len(pii.PATTERNS)}')}), b AS ({_found('d0')})
    SELECT t.info_type, (SELECT count(*) FROM b WHERE b.info_type = t.info_type) AS before,
      (SELECT count(*) FROM f WHERE f.info_type = t.info_type) AS after
    FROM (SELECT unnest(['EMAIL_ADDRESS', 'PHONE_NUMBER', 'CREDIT_CARD_NUMBER', 'IP_ADDRESS']) AS info_type) t""")
def pii_residual(s: Store):
    """Findings per type before and after protection."""
    docs = s.table("documents").select("doc_id", "text")

    def per_type(df, name):
        sizes = [F.sum(F.size(pii.find(F.col("text"), t))).alias(t) for t in privacy.TEXT_TYPES]
        rows = F.array(*[F.struct(F.lit(t).alias("info_type"), F.col(t).alias(name)) for t in privacy.TEXT_TYPES])
        return df.agg(*sizes).select(F.inline(rows))

    return per_type(docs, "before").join(per_type(privacy.protect_texts(docs, "text"), "after"), "info_type")


@query("generalize", f"""
    WITH f AS ({_found('documents')})
    SELECT 'ip' AS kind, value, {_masked('value', 'IP_ADDRESS')} AS shown, count(*) AS n FROM f
    WHERE info_type = 'IP_ADDRESS' GROUP BY 1, 2, 3
    UNION ALL SELECT 'date', CAST(CAST(o_orderdate AS DATE) AS VARCHAR), CAST(year(o_orderdate) AS VARCHAR), count(*)
    FROM orders GROUP BY 1, 2, 3
    UNION ALL SELECT 'address', address, city || ', ' || country, count(*) FROM
      ({with_roles("SELECT * FROM s_customers", "s_customers")}) GROUP BY 1, 2, 3""")
def generalize(s: Store):
    ips = privacy.findings(s.table("documents"), "doc_id", "text", types=["IP_ADDRESS"]).select(
        F.lit("ip").alias("kind"), "value", pii.generalize_ip(F.col("value")).alias("shown"))
    day = F.to_date("o_orderdate").cast("string")
    dates = s.table("orders").select(F.lit("date").alias("kind"), day.alias("value"),
                                     pii.generalize_year(day).alias("shown"))
    places = s.customers().select(F.lit("address").alias("kind"), F.col("address").alias("value"),
                                  pii.generalize_address(F.col("city"), F.col("country")).alias("shown"))
    return ips.unionByName(dates).unionByName(places).groupBy("kind", "value", "shown").agg(F.count("*").alias("n"))


@query("deidentify", with_roles(f"""
    SELECT customer_id, {_masked('email', 'EMAIL_ADDRESS')} AS email, CAST(NULL AS VARCHAR) AS first_name, last_name,
      {_masked('phone', 'PHONE_NUMBER')} AS phone, country, city, city || ', ' || country AS address
    FROM s_customers""", "s_customers"))
def deidentify(s: Store):
    return privacy.deidentify(s.customers(), {
        "email": "mask_email", "phone": "mask_phone", "first_name": "remove", "address": "city"})


@query("pii_columns", with_roles("""
    SELECT 'email' AS column_name, 'EMAIL_ADDRESS' AS info_type, count(*) AS findings FROM s_customers
    UNION ALL SELECT 'phone', 'PHONE_NUMBER', count(*) FROM s_customers
    UNION ALL SELECT 'first_name', 'PERSON_NAME', count(*) FROM s_customers
    UNION ALL SELECT 'address', 'STREET_ADDRESS', count(*) FROM s_customers""", "s_customers"))
def pii_columns(s: Store):
    """Findings per column of the customers: by pattern, names and addresses by tag."""
    people = s.customers().drop("last_name")
    return privacy.inspect_columns(people, {"first_name": "PERSON_NAME", "address": "STREET_ADDRESS"})


@query("tokenize_join", with_roles("""
    SELECT c.customer_id, c.email, count(*) AS order_count,
      CAST(sum(CAST(o.total_amount AS DECIMAL(18,4))) AS DOUBLE) AS total_spent, true AS reversible
    FROM s_customers c JOIN s_orders o ON c.customer_id = o.customer_id GROUP BY 1, 2""",
    "s_customers", "s_orders"))
def tokenize_join(s: Store):
    """Join two tables on tokens alone, then open the tokens."""
    hidden = s.customers().select("customer_id", pii.tokenize(F.col("customer_id").cast("string"), TOKEN_KEY).alias(
        "token"), pii.tokenize(F.col("email"), TOKEN_KEY).alias("email_token"))
    bought = s.orders().groupBy("customer_id").agg(
        F.count("*").alias("order_count"), gold.money_sum(F.col("total_amount")).cast("double").alias("total_spent"))
    bought = bought.withColumn("token", pii.tokenize(F.col("customer_id").cast("string"), TOKEN_KEY)).drop(
        "customer_id")
    opened = pii.detokenize(F.col("token"), {"k1": TOKEN_KEY})
    return hidden.join(bought, "token").select(
        "customer_id", pii.detokenize(F.col("email_token"), {"k1": TOKEN_KEY}).alias("email"), "order_count",
        "total_spent", (opened == F.col("customer_id").cast("string")).alias("reversible"))


POLICIES = (
    governance.RowPolicy("nation_3_only", ("n3-analysts",), "country = 'NATION_3'"),
    governance.RowPolicy("asia_only", ("asia-analysts",), "city = 'ASIA'"),
    governance.RowPolicy("all_rows", ("data-admins",), "true"),
)


@query("row_policy", with_roles("""
    SELECT 'none' AS reader, * FROM s_customers WHERE false
    UNION ALL SELECT 'both', * FROM s_customers WHERE country = 'NATION_3' OR city = 'ASIA'
    UNION ALL SELECT 'admin', * FROM s_customers""", "s_customers"))
def row_policy(s: Store):
    out = None
    for reader, groups in (("none", ()), ("both", ("n3-analysts", "asia-analysts")), ("admin", ("data-admins",))):
        seen = governance.apply_row_policies(s.customers(), POLICIES, groups).withColumn("reader", F.lit(reader))
        out = seen if out is None else out.unionByName(seen)
    return out


@query("column_policy", with_roles("""
    SELECT 'medium' AS clearance, customer_id, CAST(NULL AS VARCHAR) AS email, first_name, last_name,
      CAST(NULL AS VARCHAR) AS phone, country, city, CAST(NULL AS VARCHAR) AS address FROM s_customers
    UNION ALL SELECT 'low', customer_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM s_customers""", "s_customers"))
def column_policy(s: Store):
    tags = governance.COLUMN_TAGS["customers"]
    shown = [governance.apply_column_tags(s.customers(), tags, level).withColumn("clearance", F.lit(level))
             for level in (governance.MEDIUM, governance.LOW)]
    return shown[0].unionByName(shown[1])


@query("retention_expired", """
    SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS rows FROM orders
    WHERE o_orderdate < TIMESTAMP '2001-12-31' - INTERVAL 1825 DAY GROUP BY 1""")
def retention_expired(s: Store):
    return governance.expired_days(s.table("orders"), "o_orderdate", governance.RETENTION_DAYS["silver"], "2001-12-31")


@query("layer_counts", with_roles("""
    SELECT 'customers' AS table_name, count(*) AS row_count FROM s_customers
    UNION ALL SELECT 'events', count(*) FROM s_events UNION ALL SELECT 'inventory', count(*) FROM s_inventory
    UNION ALL SELECT 'order_items', count(*) FROM s_items UNION ALL SELECT 'orders', count(*) FROM s_orders
    UNION ALL SELECT 'payments', count(*) FROM s_payments UNION ALL SELECT 'products', count(*) FROM s_products
    UNION ALL SELECT 'reviews', count(*) FROM s_reviews""", "s_customers", "s_events", "s_inventory", "s_items",
    "s_orders", "s_payments", "s_products", "s_reviews"))
def layer_counts(s: Store):
    return checks.table_counts({name: getattr(s, name)() for name in ENTITIES})


@query("counts_by_source", "SELECT source, count(*) AS row_count FROM documents GROUP BY source")
def counts_by_source(s: Store):
    return checks.counts_by_source(s.table("documents"))


@query("duplicate_sources", "SELECT source, count(*) AS row_count FROM documents GROUP BY source HAVING count(*) > 1")
def duplicate_sources(s: Store):
    return checks.duplicate_sources(s.table("documents"))


@query("duplicate_loads", """
    SELECT 'order/' || l_orderkey AS source, CAST(l_linenumber AS VARCHAR) AS record_id, count(*) AS copies
    FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_loads(s: Store):
    return checks.duplicate_loads(s.table("lineitem").select(
        F.concat(F.lit("order/"), F.col("l_orderkey")).alias("source"),
        F.col("l_linenumber").cast("string").alias("record_id")))


@query("latest_ingested", """
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 5""")
def latest_ingested(s: Store):
    return checks.latest_ingested(s.table("orders").select("o_orderkey", "o_orderdate", "o_totalprice"), 5,
                                  "o_orderdate", "o_orderkey")


@query("quality_report", with_roles("""
    WITH oi AS (SELECT order_item_id, count(*) - 1 AS extra FROM s_items GROUP BY 1)
    SELECT 'customers' AS table_name, 'key_present' AS rule, count(*) FILTER (customer_id IS NULL) AS failures
      FROM s_customers
    UNION ALL SELECT 'customers', 'unique_key', count(*) - count(DISTINCT customer_id) FROM s_customers
    UNION ALL SELECT 'products', 'key_present', count(*) FILTER (product_id IS NULL) FROM s_products
    UNION ALL SELECT 'products', 'price_not_negative', count(*) FILTER (price < 0) FROM s_products
    UNION ALL SELECT 'products', 'unique_key', count(*) - count(DISTINCT product_id) FROM s_products
    UNION ALL SELECT 'orders', 'key_present', count(*) FILTER (order_id IS NULL) FROM s_orders
    UNION ALL SELECT 'orders', 'status_known', count(*) FILTER (status NOT IN ('pending', 'processing', 'shipped',
      'delivered', 'completed', 'cancelled')) FROM s_orders
    UNION ALL SELECT 'orders', 'shipped_after_ordered', 0
    UNION ALL SELECT 'orders', 'unique_key', count(*) - count(DISTINCT order_id) FROM s_orders
    UNION ALL SELECT 'order_items', 'key_present', count(*) FILTER (order_item_id IS NULL) FROM s_items
    UNION ALL SELECT 'order_items', 'quantity_positive', count(*) FILTER (quantity <= 0) FROM s_items
    UNION ALL SELECT 'order_items', 'total_adds_up', count(*) FILTER (
      abs(total_price - round(quantity * unit_price - discount, 2)) > 0.015) FROM s_items
    UNION ALL SELECT 'order_items', 'unique_key', CAST(sum(extra) AS BIGINT) FROM oi
    UNION ALL SELECT 'reviews', 'key_present', count(*) FILTER (review_id IS NULL) FROM s_reviews
    UNION ALL SELECT 'reviews', 'rating_in_range', count(*) FILTER (rating NOT BETWEEN 1 AND 5) FROM s_reviews
    UNION ALL SELECT 'reviews', 'unique_key', count(*) - count(DISTINCT review_id) FROM s_reviews
    UNION ALL SELECT 'inventory', 'key_present', 0
    UNION ALL SELECT 'inventory', 'reserved_within_available',
      count(*) FILTER (quantity_reserved > quantity_available) FROM s_inventory
    UNION ALL SELECT 'inventory', 'unique_key', 0
    UNION ALL SELECT 'orders', 'customer_id_exists',
      (SELECT count(*) FROM s_orders o ANTI JOIN s_customers c ON o.customer_id = c.customer_id)
    UNION ALL SELECT 'order_items', 'order_id_exists',
      (SELECT count(*) FROM s_items i ANTI JOIN s_orders o ON i.order_id = o.order_id)
    UNION ALL SELECT 'order_items', 'product_id_exists',
      (SELECT count(*) FROM s_items i ANTI JOIN s_products p ON i.product_id = p.product_id)
    UNION ALL SELECT 'reviews', 'product_id_exists',
      (SELECT count(*) FROM s_reviews r ANTI JOIN s_products p ON r.product_id = p.product_id)
    UNION ALL SELECT 'inventory', 'product_id_exists',
      (SELECT count(*) FROM s_inventory r ANTI JOIN s_products p ON r.product_id = p.product_id)
    """, "s_customers", "s_products", "s_orders", "s_items", "s_reviews", "s_inventory"))
def quality_report(s: Store):
    tables = {n: getattr(s, n)() for n in ("customers", "products", "orders", "order_items", "reviews", "inventory")}
    return checks.quality_report(tables, tolerance=0.015)


@query("scan_bytes")
def scan_bytes(s: Store):
    """Bytes of a day-partitioned copy of the events against those of one day of it."""
    spec = ENTITIES["events"]
    events = s.events()
    table = Table(s.spark, scratch_path(s.spark, "events"), events.drop("value").schema, spec.partition_column,
                  spec.partition, ("event_type", "customer_id")).create()
    table.append(events)
    return checks.scan_bytes(table.read(), table.read("2024-01-10", "2024-01-10"))


@query("order_total_differences", """
    SELECT o_orderkey AS order_id, o_totalprice AS total_amount, items_total
    FROM orders JOIN (SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(28,6))) AS DOUBLE) AS items_total
                      FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
    WHERE abs(o_totalprice - items_total) > 0.01""")
def order_total_differences(s: Store):
    return checks.order_total_differences(s.orders(), s.order_items())


@query("recent_events", """
    SELECT event_id, event_type, ts AS event_timestamp FROM events
    WHERE ts > TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 15 MINUTE""")
def recent_events(s: Store):
    """Events of the last 15 minutes before a fixed instant, and later ones."""
    found = ingest.recent_rows(s.table("events"), "15 minutes", "ts", "2024-01-20 12:00:00")
    return found.select("event_id", "event_type", F.col("ts").alias("event_timestamp"))


@query("rows_of_one_source", """
    SELECT doc_id, lang, n_chars FROM documents WHERE source = 'src7'""")
def rows_of_one_source(s: Store):
    return ingest.rows_from(s.table("documents"), "src7").select("doc_id", "lang", "n_chars")
