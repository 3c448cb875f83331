"""Gold metrics over the benchmark tables."""

from __future__ import annotations

from mercato.catalog.registry import query
from mercato.catalog.roles import Store, with_roles
from mercato.plans import gold

AS_OF = "2001-12-31"
_MONEY = "CAST({} AS DECIMAL(18,4))"
_TOTAL = _MONEY.format("o.total_amount")


@query("daily_revenue", with_roles(f"""
    SELECT CAST(o.ordered_at AS DATE) AS date, CAST(sum({_TOTAL}) AS DOUBLE) AS total_revenue,
      count(DISTINCT o.order_id) AS order_count,
      CAST(sum({_TOTAL}) AS DOUBLE) / count(o.total_amount) AS avg_order_value,
      CAST(sum(i.quantity) AS BIGINT) AS items_sold, count(DISTINCT o.customer_id) AS unique_customers, o.currency
    FROM s_orders o JOIN s_items i ON o.order_id = i.order_id
    WHERE o.status IN ('completed', 'delivered') GROUP BY CAST(o.ordered_at AS DATE), o.currency
    """, "s_orders", "s_items"))
def daily_revenue(s: Store):
    return gold.daily_revenue(s.orders(), s.order_items())


@query("daily_revenue_exact", with_roles(f"""
    WITH per_order AS (SELECT order_id, sum(quantity) AS quantity FROM s_items GROUP BY order_id)
    SELECT CAST(o.ordered_at AS DATE) AS date, CAST(sum({_TOTAL}) AS DOUBLE) AS total_revenue,
      count(DISTINCT o.order_id) AS order_count,
      CAST(sum({_TOTAL}) AS DOUBLE) / count(o.total_amount) AS avg_order_value,
      CAST(sum(p.quantity) AS BIGINT) AS items_sold, count(DISTINCT o.customer_id) AS unique_customers, o.currency
    FROM s_orders o JOIN per_order p ON o.order_id = p.order_id
    WHERE o.status IN ('completed', 'delivered') GROUP BY CAST(o.ordered_at AS DATE), o.currency
    """, "s_orders", "s_items"))
def daily_revenue_exact(s: Store):
    return gold.daily_revenue_exact(s.orders(), s.order_items())


_CUSTOMERS = f"""
    SELECT c.customer_id, c.first_name, c.last_name, c.country,
      CAST(sum({_TOTAL}) AS DOUBLE) AS total_spent, count(DISTINCT o.order_id) AS order_count,
      CAST(sum({_TOTAL}) AS DOUBLE) / count(o.total_amount) AS avg_order_value,
      min(o.ordered_at) AS first_order_date, max(o.ordered_at) AS last_order_date,
      CAST(date_diff('day', CAST(max(o.ordered_at) AS DATE), DATE '{AS_OF}') AS INTEGER) AS days_since_last_order,
      CASE WHEN count(DISTINCT o.order_id) >= 10 THEN 'VIP' WHEN count(DISTINCT o.order_id) >= 5 THEN 'Loyal'
        WHEN count(DISTINCT o.order_id) >= 2 THEN 'Returning' ELSE 'New' END AS customer_segment
    FROM s_customers c LEFT JOIN s_orders o ON c.customer_id = o.customer_id
    WHERE o.status IN ('completed', 'delivered')
    GROUP BY c.customer_id, c.first_name, c.last_name, c.country"""


@query("customer_metrics", with_roles(_CUSTOMERS, "s_customers", "s_orders"))
def customer_metrics(s: Store):
    return gold.customer_metrics(s.customers(), s.orders(), AS_OF)


@query("customer_segment", with_roles(f"""
    SELECT customer_segment, count(*) AS customers,
      CAST(sum({_MONEY.format('total_spent')}) AS DOUBLE) AS total_spent
    FROM ({_CUSTOMERS}) GROUP BY customer_segment""", "s_customers", "s_orders"))
def customer_segment(s: Store):
    return gold.customer_segments(s.customers(), s.orders())


def _products(fan_out: bool) -> str:
    # The joined form multiplies sales by reviews; summed per product first it is the same product.
    times = "greatest(coalesce(r.n, 1), 1)" if fan_out else "1"
    return f"""
    WITH sold AS (SELECT product_id, sum(CAST(total_price AS DECIMAL(18,4))) AS revenue, sum(quantity) AS units,
        count(DISTINCT order_id) AS orders FROM s_items GROUP BY product_id),
      rated AS (SELECT product_id, avg(rating) AS avg_rating, count(*) AS n FROM s_reviews GROUP BY product_id)
    SELECT p.product_id, p.name AS product_name, p.category,
      coalesce(CAST(i.revenue * {times} AS DOUBLE), 0.0) AS total_revenue,
      CAST(coalesce(i.units * {times}, 0) AS BIGINT) AS units_sold, coalesce(i.orders, 0) AS order_count,
      r.avg_rating, coalesce(r.n, 0) AS review_count
    FROM s_products p LEFT JOIN sold i ON p.product_id = i.product_id
    LEFT JOIN rated r ON p.product_id = r.product_id"""


@query("product_metrics", with_roles("""
    SELECT p.product_id, p.name AS product_name, p.category,
      coalesce(CAST(sum(CAST(i.total_price AS DECIMAL(18,4))) AS DOUBLE), 0.0) AS total_revenue,
      CAST(coalesce(sum(i.quantity), 0) AS BIGINT) AS units_sold, count(DISTINCT i.order_id) AS order_count,
      avg(r.rating) AS avg_rating, count(DISTINCT r.review_id) AS review_count
    FROM s_products p LEFT JOIN s_items i ON p.product_id = i.product_id
    LEFT JOIN s_reviews r ON p.product_id = r.product_id
    GROUP BY p.product_id, p.name, p.category""", "s_products", "s_items", "s_reviews"))
def product_metrics(s: Store):
    return gold.product_metrics(s.products(), s.order_items(), s.reviews())


@query("product_metrics_exact", with_roles(_products(False), "s_products", "s_items", "s_reviews"))
def product_metrics_exact(s: Store):
    return gold.product_metrics_exact(s.products(), s.order_items(), s.reviews())


@query("product_return_rate", with_roles("""
    WITH bought AS (SELECT DISTINCT product_id, order_id FROM s_items),
      refunded AS (SELECT DISTINCT order_id FROM s_payments WHERE status = 'refunded')
    SELECT b.product_id, count(*) AS order_count, count(r.order_id) AS returned_orders,
      CAST(count(r.order_id) AS DOUBLE) / count(*) AS return_rate
    FROM bought b LEFT JOIN refunded r ON b.order_id = r.order_id GROUP BY b.product_id
    """, "s_items", "s_payments"))
def product_return_rate(s: Store):
    return gold.product_return_rate(s.order_items(), s.payments())


@query("top_products_by_category", with_roles("""
    WITH sold AS (SELECT product_id, sum(CAST(total_price AS DECIMAL(18,4))) AS revenue, sum(quantity) AS units
        FROM s_items GROUP BY product_id),
      ranked AS (SELECT category, p.product_id, name, revenue, units,
        row_number() OVER (PARTITION BY category ORDER BY revenue DESC, p.product_id) AS r
        FROM s_products p JOIN sold USING (product_id))
    SELECT category, product_id, name AS product_name, CAST(revenue AS DOUBLE) AS total_revenue,
      CAST(units AS BIGINT) AS units_sold, CAST(r AS INTEGER) AS rank_in_category FROM ranked WHERE r <= 5
    """, "s_items", "s_products"))
def top_products_by_category(s: Store):
    return gold.top_products_by_category(s.products(), s.order_items(), 5)


_T = _MONEY.format("total_amount")


@query("monthly_kpis", with_roles(f"""
    SELECT CAST(date_trunc('month', ordered_at) AS TIMESTAMP) AS month, CAST(sum({_T}) AS DOUBLE) AS total_revenue,
      count(DISTINCT order_id) AS order_count, count(DISTINCT customer_id) AS active_customers,
      CAST(sum({_T}) AS DOUBLE) / count(total_amount) AS avg_order_value
    FROM s_orders WHERE status IN ('completed', 'delivered') GROUP BY 1""", "s_orders"))
def monthly_kpis(s: Store):
    return gold.monthly_kpis(s.orders())


@query("monthly_kpis_full", with_roles(f"""
    WITH firsts AS (SELECT customer_id, min(ordered_at) AS first_at FROM s_orders GROUP BY customer_id)
    SELECT CAST(date_trunc('month', ordered_at) AS TIMESTAMP) AS month, CAST(sum({_T}) AS DOUBLE) AS total_revenue,
      count(DISTINCT order_id) AS order_count, count(DISTINCT o.customer_id) AS active_customers,
      count(DISTINCT CASE WHEN date_trunc('month', ordered_at) = date_trunc('month', first_at)
        THEN o.customer_id END) AS new_customers,
      count(DISTINCT CASE WHEN date_trunc('month', ordered_at) > date_trunc('month', first_at)
        THEN o.customer_id END) AS returning_customers,
      CAST(sum({_T}) AS DOUBLE) / count(total_amount) AS avg_order_value,
      CAST(NULL AS DOUBLE) AS conversion_rate, CAST(NULL AS DOUBLE) AS cart_abandonment_rate
    FROM s_orders o LEFT JOIN firsts f ON o.customer_id = f.customer_id
    WHERE status IN ('completed', 'delivered') GROUP BY 1""", "s_orders"))
def monthly_kpis_full(s: Store):
    return gold.monthly_kpis_full(s.orders())


@query("monthly_rates", with_roles("""
    WITH sessions AS (SELECT CAST(date_trunc('month', event_timestamp) AS TIMESTAMP) AS month, session_id,
        count(*) FILTER (event_type = 'page_view') AS views, count(*) FILTER (event_type = 'purchase') AS buys,
        count(*) FILTER (event_type = 'add_to_cart') AS carts FROM s_events GROUP BY 1, 2)
    SELECT month, CAST(sum(buys) AS DOUBLE) / nullif(sum(views), 0) AS conversion_rate,
      1.0 - CAST(count(*) FILTER (carts > 0 AND buys > 0) AS DOUBLE) / nullif(count(*) FILTER (carts > 0), 0)
        AS cart_abandonment_rate
    FROM sessions GROUP BY month""", "s_events"))
def monthly_rates(s: Store):
    return gold.monthly_rates(s.events())


_FUNNEL = """
    SELECT CAST(event_timestamp AS DATE) AS date, count(*) FILTER (event_type = 'page_view') AS page_views,
      count(*) FILTER (event_type = 'product_view') AS product_views,
      count(*) FILTER (event_type = 'add_to_cart') AS add_to_cart,
      count(*) FILTER (event_type = 'checkout_start') AS checkout_started,
      count(*) FILTER (event_type = 'purchase') AS orders_completed,
      CAST(count(*) FILTER (event_type = 'add_to_cart') AS DOUBLE)
        / nullif(count(*) FILTER (event_type = 'product_view'), 0) AS view_to_cart_rate,
      CAST(count(*) FILTER (event_type = 'checkout_start') AS DOUBLE)
        / nullif(count(*) FILTER (event_type = 'add_to_cart'), 0) AS cart_to_checkout_rate,
      CAST(count(*) FILTER (event_type = 'purchase') AS DOUBLE)
        / nullif(count(*) FILTER (event_type = 'checkout_start'), 0) AS checkout_to_purchase_rate
    FROM s_events GROUP BY 1"""


@query("conversion_funnel", with_roles(_FUNNEL, "s_events"))
def conversion_funnel(s: Store):
    return gold.conversion_funnel(s.events())


@query("traffic_stats", with_roles("""
    SELECT count(*) AS total, count(*) FILTER (event_type = 'page_view') AS page_view,
      count(*) FILTER (event_type = 'product_view') AS product_view, count(*) FILTER (event_type = 'search') AS search,
      count(*) FILTER (event_type = 'add_to_cart') AS add_to_cart,
      count(*) FILTER (event_type = 'remove_from_cart') AS remove_from_cart,
      count(*) FILTER (event_type = 'checkout_start') AS checkout_start,
      count(*) FILTER (event_type = 'purchase') AS purchase,
      CAST(count(*) FILTER (event_type = 'add_to_cart') AS DOUBLE)
        / nullif(count(*) FILTER (event_type = 'product_view'), 0) * 100 AS view_to_cart_pct,
      CAST(count(*) FILTER (event_type = 'purchase') AS DOUBLE)
        / nullif(count(*) FILTER (event_type = 'checkout_start'), 0) * 100 AS checkout_to_buy_pct
    FROM s_events""", "s_events"))
def traffic_stats(s: Store):
    return gold.traffic_stats(s.events())


@query("event_type_counts", with_roles(
    "SELECT event_type, count(*) AS total FROM s_events GROUP BY event_type ORDER BY total DESC, event_type",
    "s_events"))
def event_type_counts(s: Store):
    return gold.event_type_counts(s.events())


@query("enrich_events", with_roles("""
    SELECT e.event_id, e.event_type, e.event_timestamp, e.product_id, p.name AS product_name, p.category, p.price,
      c.customer_id, c.first_name, c.country
    FROM s_events e LEFT JOIN s_products p ON e.product_id = p.product_id
    LEFT JOIN s_customers c ON e.customer_id = c.customer_id""", "s_events", "s_products", "s_customers"))
def enrich_events(s: Store):
    return gold.enrich_events(s.events().drop("session_id", "value"), s.products(), s.customers())


@query("low_stock", with_roles("""
    WITH free AS (SELECT product_id, warehouse, quantity_available - quantity_reserved AS free_units FROM s_inventory),
      levels AS (SELECT product_id, CAST(warehouse AS VARCHAR) AS warehouse, free_units, 'warehouse' AS level FROM free
        UNION ALL SELECT product_id, NULL, CAST(sum(free_units) AS BIGINT), 'product' FROM free GROUP BY product_id)
    SELECT product_id, warehouse, free_units, level FROM levels WHERE free_units < 10""", "s_inventory"))
def low_stock(s: Store):
    stock = s.inventory()
    return gold.low_stock(stock.withColumn("warehouse", stock.warehouse.cast("string")), 10)


@query("payment_summary", with_roles("""
    SELECT CAST(paid_at AS DATE) AS date, payment_method, count(*) AS payments,
      coalesce(CAST(sum(CAST(amount AS DECIMAL(18,4))) FILTER (status = 'completed') AS DOUBLE), 0) AS paid_amount,
      coalesce(CAST(sum(CAST(amount AS DECIMAL(18,4))) FILTER (status = 'failed') AS DOUBLE), 0) AS failed_amount,
      coalesce(CAST(sum(CAST(amount AS DECIMAL(18,4))) FILTER (status = 'refunded') AS DOUBLE), 0) AS refunded_amount
    FROM s_payments GROUP BY 1, 2""", "s_payments"))
def payment_summary(s: Store):
    return gold.payment_summary(s.payments())
