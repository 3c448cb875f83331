"""Windows, sessions, gaps and carts over the benchmark events."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.catalog.registry import query
from mercato.catalog.roles import Store, with_roles
from mercato.operators import behaviour

TYPES = ("page_view", "product_view", "add_to_cart", "checkout_start", "purchase")
_SLOT = "CAST(floor(epoch_us(event_timestamp) / (CAST({0} AS DOUBLE) * 1000000)) AS BIGINT)"


def _at(slot: str, seconds: int) -> str:
    return f"make_timestamp(CAST(({slot}) * {seconds} AS BIGINT) * 1000000)"


@query("event_metrics_5min", with_roles(f"""
    SELECT {_at('slot', 300)} AS window_start, {_at('slot + 1', 300)} AS window_end, event_type, event_count
    FROM (SELECT {_SLOT.format(300)} AS slot, event_type, count(*) AS event_count FROM s_events GROUP BY 1, 2)
    """, "s_events"))
def event_metrics_5min(s: Store):
    return behaviour.event_metrics_5min(s.events())


@query("sliding_event_counts", with_roles(f"""
    SELECT {_at('slot - back', 60)} AS window_start, {_at('slot - back + 5', 60)} AS window_end, event_type,
      count(*) AS event_count
    FROM (SELECT {_SLOT.format(60)} AS slot, event_type FROM s_events), generate_series(0, 4) g(back)
    GROUP BY 1, 2, 3""", "s_events"))
def sliding_event_counts(s: Store):
    return behaviour.sliding_event_counts(s.events())


_SESSIONS = """
    WITH marked AS (SELECT *, CASE WHEN epoch_us(event_timestamp) - epoch_us(lag(event_timestamp) OVER w)
        <= CAST({gap} AS BIGINT) * 1000000 THEN 0 ELSE 1 END AS opens FROM {events} WINDOW w AS
        (PARTITION BY {key} ORDER BY event_timestamp, event_id)),
      runs AS (SELECT *, sum(opens) OVER (PARTITION BY {key} ORDER BY event_timestamp, event_id) AS run FROM marked)"""


@query("user_sessions", with_roles(_SESSIONS.format(gap=1800, events="s_events", key="customer_id") + """
    SELECT customer_id, min(event_timestamp) AS session_start,
      max(event_timestamp) + INTERVAL 30 MINUTE AS session_end, count(*) AS event_count
    FROM runs GROUP BY customer_id, run""", "s_events"))
def user_sessions(s: Store):
    return behaviour.user_sessions(s.events())


@query("abandoned_carts", with_roles(_SESSIONS.format(
    gap=7200, key="session_id",
    events="(SELECT * FROM s_events WHERE event_type IN ('add_to_cart', 'purchase'))") + """,
    carts AS (SELECT session_id, run, max(event_timestamp) AS ended,
        max(event_timestamp) FILTER (event_type = 'add_to_cart') AS last_cart,
        max(event_timestamp) FILTER (event_type = 'purchase') AS last_purchase,
        count(*) FILTER (event_type = 'add_to_cart') AS cart_events FROM runs GROUP BY session_id, run)
    SELECT session_id, cart_events, last_cart, ended + INTERVAL 2 HOUR AS abandoned_at FROM carts
    WHERE last_cart IS NOT NULL AND (last_purchase IS NULL OR last_purchase < last_cart)
      AND ended + INTERVAL 2 HOUR <= TIMESTAMP '2024-01-30 12:00:00'""", "s_events"))
def abandoned_carts(s: Store):
    return behaviour.abandoned_carts(s.events(), 7200, F.lit("2024-01-30 12:00:00").cast("timestamp"))


@query("event_gaps", with_roles("""
    WITH steps AS (SELECT event_timestamp, lag(event_timestamp) OVER (ORDER BY event_timestamp) AS before FROM s_events)
    SELECT before AS gap_start, event_timestamp AS gap_end,
      CAST(epoch_us(event_timestamp) - epoch_us(before) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS gap_seconds
    FROM steps WHERE epoch_us(event_timestamp) - epoch_us(before) > 300000000""", "s_events"))
def event_gaps(s: Store):
    return behaviour.event_gaps(s.events())


@query("session_paths", with_roles("""
    SELECT session_id, event_id, event_type, event_timestamp,
      row_number() OVER w AS step, lag(event_type) OVER w AS previous_type,
      CAST(epoch_us(event_timestamp) - epoch_us(lag(event_timestamp) OVER w) AS DOUBLE) / CAST(1000000 AS DOUBLE)
        AS seconds_since_previous
    FROM s_events WINDOW w AS (PARTITION BY session_id ORDER BY event_timestamp, event_id)""", "s_events"))
def session_paths(s: Store):
    return behaviour.session_paths(s.events())


@query("silent_windows", with_roles(f"""
    WITH slots AS (SELECT {_SLOT.format(300)} AS slot, event_type FROM s_events),
      spine AS (SELECT slot, event_type FROM (SELECT unnest(generate_series(min(slot), max(slot))) AS slot FROM slots),
        (SELECT unnest(['page_view', 'product_view', 'add_to_cart', 'checkout_start', 'purchase']) AS event_type)),
      counts AS (SELECT slot, event_type, count(*) AS n FROM slots GROUP BY 1, 2),
      filled AS (SELECT s.slot, s.event_type, coalesce(n, 0) AS n FROM spine s LEFT JOIN counts c
        ON s.slot = c.slot AND s.event_type = c.event_type),
      rolled AS (SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY slot ROWS 2 PRECEDING) AS lately FROM filled)
    SELECT {_at('slot', 300)} AS window_start, event_type, n AS event_count, lately = 0 AS outage
    FROM rolled WHERE n = 0""", "s_events"))
def silent_windows(s: Store):
    return behaviour.silent_windows(s.events(), TYPES)


@query("conversion_drop", with_roles(f"""
    WITH rates AS (SELECT {_SLOT.format(3600)} AS slot,
        CAST(count(*) FILTER (event_type = 'purchase') AS DOUBLE)
          / nullif(count(*) FILTER (event_type = 'checkout_start'), 0) AS rate FROM s_events GROUP BY 1)
    SELECT {_at('a.slot', 3600)} AS window_start, a.rate, b.rate AS previous_rate
    FROM rates a JOIN rates b ON b.slot = a.slot - 1
    WHERE b.rate > 0 AND a.rate <= b.rate * 0.5""", "s_events"))
def conversion_drop(s: Store):
    return behaviour.conversion_drop(s.events(), 3600)
