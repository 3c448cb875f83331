"""Click messages: checking, error handling, union of channels, streaming runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.catalog.behaviour_queries import TYPES
from mercato.catalog.control_queries import TOKEN_KEY
from mercato.catalog.merge_queries import FIRST_LOAD, iso
from mercato.catalog.registry import query
from mercato.catalog.roles import SCHEMAS, Store, silver_events, with_roles
from mercato.functions import pii
from mercato.lakehouse import Lakehouse, Table
from mercato.operators import checks
from mercato.operators.merge import merge_into
from mercato.operators.privacy import DEFAULT_POLICY
from mercato.session import scratch_path
from mercato.sources import messages
from mercato.streaming import carts, jobs, outages


def click_messages(events: DataFrame) -> DataFrame:
    """Events as message text. Checkouts and cart events arrive damaged, in ways their value decides."""
    clicks = silver_events(events)
    value, kind = F.col("value"), F.col("event_type")
    tail = F.concat(
        F.lit(',"customer_id":"'), F.col("customer_id"), F.lit('","session_id":"'), F.col("session_id"),
        F.lit('","product_id":null,"timestamp":"'), iso(F.col("event_timestamp")), F.lit('"}'))
    fine = F.concat(F.lit('{"event_id":"ev-'), F.col("event_id"), F.lit('","event_type":"'), kind, F.lit('"'), tail)
    no_id = F.concat(F.lit('{"event_id":'), F.when(value < 10, "null").when(value < 20, '""').when(
        value < 30, "0").when(value < 40, "false").when(value < 50, "[]").when(value < 60, '"0"').otherwise("{}"),
        F.lit(',"event_type":"'), kind, F.lit('"'), tail)
    broken = F.when(value < 20, F.rtrim(fine, F.lit("}"))).when(value < 40, F.concat(F.lit("["), fine, F.lit("]"))).when(
        value < 60, F.concat(fine, F.lit(" "), fine)).when(value < 80, F.translate(fine, '"', "'")).otherwise(fine)
    text = F.when(kind == "add_to_cart", no_id).when(kind == "checkout_start", broken).otherwise(fine)
    return clicks.select(F.col("event_id").alias("msg_id"), F.col("event_timestamp").alias("sent_at"),
                         text.alias("value"))


# What the damage above must lead to.
_CHECKED = with_roles("""
    WITH checked AS (SELECT event_id AS msg_id, event_timestamp AS sent_at, session_id,
      CASE WHEN event_type = 'add_to_cart' THEN CASE WHEN value < 10 THEN NULL WHEN value < 20 THEN ''
          WHEN value < 30 THEN '0' WHEN value < 40 THEN 'false' WHEN value < 50 THEN '[]'
          WHEN value < 60 THEN '0' ELSE '{}' END
        WHEN event_type = 'checkout_start' AND value < 80 THEN NULL ELSE 'ev-' || event_id END AS event_id,
      CASE WHEN event_type = 'checkout_start' AND value < 80 THEN NULL ELSE event_type END AS event_type,
      CASE WHEN event_type = 'checkout_start' AND value < 80 THEN 'invalid_json'
        WHEN event_type = 'add_to_cart' AND (value < 50 OR value >= 60) THEN 'missing_required_fields' END
        AS error_type, event_type = 'checkout_start' AND value < 20 AS cut FROM s_events)
    """, "s_events")


@query("validate_events", _CHECKED + """
    SELECT event_id, event_type, split_part(session_id, '-', 1) AS customer_id, session_id,
      sent_at AS event_timestamp FROM checked WHERE error_type IS NULL""")
def validate_events(s: Store):
    good, _ = messages.split_events(click_messages(s.table("events")), now=FIRST_LOAD)
    return jobs.typed_events(good).select("event_id", "event_type", "customer_id", "session_id", "event_timestamp")


@query("split_events", _CHECKED + "SELECT msg_id, event_id, event_type, error_type FROM checked")
def split_events(s: Store):
    return messages.check_events(click_messages(s.table("events"))).select(
        "msg_id", "event_id", "event_type", "error_type")


def stored_errors(s: Store) -> DataFrame:
    sent = click_messages(s.table("events"))
    return messages.event_errors(messages.check_events(sent, now=F.col("sent_at")))


@query("error_summary", _CHECKED + """
    SELECT error_type, count(*) AS errors FROM checked WHERE error_type IS NOT NULL GROUP BY error_type""")
def error_summary(s: Store):
    return checks.error_summary(stored_errors(s))


@query("error_alerts", _CHECKED + """
    SELECT time_bucket(INTERVAL 10 MINUTE, sent_at) AS window_start, count(*) AS errors FROM checked
    WHERE error_type IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def error_alerts(s: Store):
    return checks.error_alerts(stored_errors(s), above=1)


@query("replay_errors", _CHECKED + """
    SELECT 'ev-' || msg_id AS event_id, 'checkout_start' AS event_type, sent_at AS event_timestamp
    FROM checked WHERE cut""")
def replay_errors(s: Store):
    """Cut-off messages get their closing brace back and pass the second time."""
    cut = F.endswith(F.col("raw_message"), F.lit('"')) & F.startswith(F.col("raw_message"), F.lit("{"))
    repair = F.when(cut, F.concat("raw_message", F.lit("}"))).otherwise(F.col("raw_message"))
    recovered, _ = messages.replay_errors(stored_errors(s), repair, now=FIRST_LOAD)
    return jobs.typed_events(recovered).select("event_id", "event_type", "event_timestamp")


@query("flatten", """
    SELECT 'web' AS channel, CAST(event_id AS VARCHAR) AS message_id, event_type AS kind FROM events
    UNION ALL SELECT 'pos', CAST(o_orderkey AS VARCHAR), o_orderpriority FROM orders
    UNION ALL SELECT 'mobile', conv_id || '/' || turn, role FROM conversations""")
def flatten(s: Store):
    return messages.flatten({
        "web": s.table("events").select(F.col("event_id").cast("string").alias("message_id"),
                                        F.col("event_type").alias("kind")),
        "pos": s.table("orders").select(F.col("o_orderkey").cast("string").alias("message_id"),
                                        F.col("o_orderpriority").alias("kind")),
        "mobile": s.table("conversations").select(F.concat_ws("/", "conv_id", "turn").alias("message_id"),
                                                  F.col("role").alias("kind")),
    })


# ---- streaming runs over the events table as a file source


def event_stream(s: Store) -> DataFrame:
    # Braces make it a pattern, which the source accepts for a file and a folder alike.
    return s.spark.readStream.schema(SCHEMAS["events"]).parquet(f"{s.sf_dir}/{{events}}.parquet")


def finished(s: Store, label: str, stream: DataFrame, schema) -> DataFrame:
    """Run a stream to its end into a table of its own and read that."""
    where = scratch_path(s.spark, label)
    table = Table(s.spark, f"{where}/table", schema).create()
    jobs.to_table(stream, table, f"{where}/checkpoint").awaitTermination()
    return table.read()


# Windows are final, and written, once the watermark (newest event less 10 minutes) passes their end.
_FINAL = "(SELECT max(event_timestamp) - INTERVAL 10 MINUTE FROM s_events)"


@query("stream_events_to_bronze", _CHECKED + """
    SELECT coalesce(error_type, 'valid') AS outcome, count(*) AS messages FROM checked GROUP BY 1""")
def stream_events_to_bronze(s: Store):
    lake = Lakehouse(s.spark, scratch_path(s.spark, "stream")).create()
    jobs.events_to_bronze(lake, click_messages(event_stream(s)).select("value"), f"{lake.root}/checkpoint",
                          now=FIRST_LOAD).awaitTermination()
    stored = lake.bronze("events_raw").read().select(F.lit("valid").alias("outcome"))
    failed = lake.bronze("events_errors").read().select(F.col("error_type").alias("outcome"))
    return stored.unionByName(failed).groupBy("outcome").agg(F.count("*").alias("messages"))


def account_messages(customers: DataFrame) -> DataFrame:
    """Sign-ups with personal data two levels down; every tenth message is cut off."""
    number = F.split_part("c_name", F.lit("#"), F.lit(2))
    text = F.concat(
        F.lit('{"event_id":"c-'), F.col("c_custkey"), F.lit('","event_type":"signup","city":"'), F.col("c_mktsegment"),
        F.lit('","country":"'), F.col("c_nationkey"), F.lit('","address":"Road '), number, F.lit('","profile":{"first_name":"'),
        F.col("c_name"), F.lit('","contacts":[{"Email":"buyer.'), number, F.lit('@example.com","phone":"+1'), number,
        F.lit('"},{"ip_address":"10.9.8.7","credit_card":"3782822'), number, F.lit('"}]}}'))
    whole = F.length(text)
    return customers.select(F.when(F.col("c_custkey") % 10 == 0, F.left(text, whole - 1)).otherwise(text).alias("value"))


@query("stream_deidentify", """
    WITH c AS (SELECT *, split_part(c_name, '#', 2) AS number FROM customer)
    SELECT 'c-' || c_custkey AS event_id, 'signup' AS event_type, c_mktsegment || ', ' || c_nationkey AS address,
      c_name AS first_name, 'buyer.' || number || '@example.com' AS email, '+*' || repeat('*', length(number) - 1) || right(number, 1) AS phone,
      '10.9.8.0/24' AS ip_address, repeat('*', 3 + length(number)) || right(number, 4) AS credit_card, false AS in_clear
    FROM c WHERE c_custkey % 10 <> 0
    UNION ALL SELECT 'c-' || c_custkey, NULL, NULL, c_name, 'buyer.' || number || '@example.com', NULL, NULL, NULL, false
    FROM c WHERE c_custkey % 10 = 0""")
def stream_deidentify(s: Store):
    """Every technique of the default policy on nested fields, tokens opened again; bad messages are sealed whole."""
    lake = Lakehouse(s.spark, scratch_path(s.spark, "hidden")).create()
    sent = s.spark.readStream.schema(SCHEMAS["customer"]).parquet(f"{s.sf_dir}/{{customer}}.parquet")
    jobs.events_to_bronze(lake, account_messages(sent), f"{lake.root}/checkpoint", policy=DEFAULT_POLICY, key=TOKEN_KEY,
                          now=FIRST_LOAD).awaitTermination()
    clear = F.col("text").rlike("buyer|Customer#|Road ") | (F.size(pii.find(F.col("text"), "EMAIL_ADDRESS")) > 0)
    opened = lambda token: pii.detokenize(token, {"k1": TOKEN_KEY})
    at = lambda path: F.get_json_object("text", path)
    good = lake.bronze("events_raw").read().withColumnRenamed("raw_payload", "text").select(
        "event_id", "event_type", at("$.address").alias("address"), opened(at("$.profile.first_name")).alias("first_name"),
        opened(at("$.profile.contacts[0].Email")).alias("email"), at("$.profile.contacts[0].phone").alias("phone"),
        at("$.profile.contacts[1].ip_address").alias("ip_address"), at("$.profile.contacts[1].credit_card").alias("credit_card"),
        clear.alias("in_clear"))
    part = lambda pattern: F.regexp_extract(opened(F.col("text")), pattern, 1)
    none = F.lit(None).cast("string")
    bad = lake.bronze("events_errors").read().withColumnRenamed("raw_message", "text").select(
        part('"event_id":"([^"]*)"').alias("event_id"), none.alias("event_type"), none.alias("address"),
        part('"first_name":"([^"]*)"').alias("first_name"), part('"Email":"([^"]*)"').alias("email"), none.alias("phone"),
        none.alias("ip_address"), none.alias("credit_card"), clear.alias("in_clear"))
    return good.unionByName(bad)


@query("stream_csv_to_bronze", with_roles("""
    SELECT CAST(review_id AS VARCHAR) AS review_id, CAST(product_id AS VARCHAR) AS product_id, rating
    FROM s_reviews""", "s_reviews"))
def stream_csv_to_bronze(s: Store):
    """Reviews as CSV files in a landing folder, picked up by the file stream, merged."""
    home = scratch_path(s.spark, "inbox")
    lake = Lakehouse(s.spark, f"{home}/lake").create()
    made = s.reviews().select("review_id", "product_id", "customer_id", "rating", F.lit("").alias("title"),
                              F.lit("").alias("comment"), iso(F.col("created_at")).alias("created_at"))
    made.write.option("header", "true").csv(f"{home}/landing/reviews")
    jobs.csv_to_bronze(lake, f"{home}/landing", "reviews", f"{home}/checkpoint", now=FIRST_LOAD).awaitTermination()
    merge_into(lake, "reviews", now=FIRST_LOAD)
    return lake.silver("reviews").read().select("review_id", "product_id", "rating")


@query("stream_event_metrics_5min", with_roles(f"""
    SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS window_start,
      time_bucket(INTERVAL 5 MINUTE, event_timestamp) + INTERVAL 5 MINUTE AS window_end, event_type,
      count(*) AS event_count FROM s_events GROUP BY 1, 2, 3 HAVING window_end <= {_FINAL}""", "s_events"))
def stream_event_metrics(s: Store):
    counts = jobs.window_counts(silver_events(event_stream(s)))
    return finished(s, "windows", counts, counts.schema)


@query("stream_user_sessions", with_roles(f"""
    WITH marked AS (SELECT *, CASE WHEN epoch_us(event_timestamp) - epoch_us(lag(event_timestamp) OVER w)
        <= 1800000000 THEN 0 ELSE 1 END AS opens FROM s_events WINDOW w AS
        (PARTITION BY customer_id ORDER BY event_timestamp, event_id)),
      runs AS (SELECT *, sum(opens) OVER (PARTITION BY customer_id ORDER BY event_timestamp, event_id) AS run
        FROM marked)
    SELECT customer_id, min(event_timestamp) AS session_start,
      max(event_timestamp) + INTERVAL 30 MINUTE AS session_end, count(*) AS event_count
    FROM runs GROUP BY customer_id, run HAVING session_end <= {_FINAL}""", "s_events"))
def stream_user_sessions(s: Store):
    sessions = jobs.user_sessions(silver_events(event_stream(s)))
    return finished(s, "sessions", sessions, sessions.schema)


@query("stream_abandoned_carts", with_roles(f"""
    WITH steps AS (SELECT * FROM s_events WHERE event_type IN ('add_to_cart', 'purchase')),
      marked AS (SELECT *, CASE WHEN epoch_us(event_timestamp) - epoch_us(lag(event_timestamp) OVER w)
        <= 7200000000 THEN 0 ELSE 1 END AS opens FROM steps WINDOW w AS
        (PARTITION BY session_id ORDER BY event_timestamp, event_id)),
      runs AS (SELECT *, sum(opens) OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS run
        FROM marked),
      carts AS (SELECT session_id, run, max(event_timestamp) + INTERVAL 2 HOUR AS abandoned_at,
        max(event_timestamp) FILTER (event_type = 'add_to_cart') AS last_cart,
        max(event_timestamp) FILTER (event_type = 'purchase') AS last_purchase,
        count(*) FILTER (event_type = 'add_to_cart') AS cart_events FROM runs GROUP BY session_id, run)
    SELECT session_id, cart_events, last_cart, abandoned_at FROM carts WHERE last_cart IS NOT NULL
      AND (last_purchase IS NULL OR last_purchase < last_cart)
      AND abandoned_at <= (SELECT max(event_timestamp) - INTERVAL 10 MINUTE FROM steps)""", "s_events"))
def stream_abandoned_carts(s: Store):
    carts = jobs.abandoned_carts(silver_events(event_stream(s)), "2 hours")
    return finished(s, "carts", carts, carts.schema)


@query("stream_cart_timer", with_roles(f"""
    WITH steps AS (SELECT * FROM s_events WHERE event_type IN ('add_to_cart', 'purchase')),
      marked AS (SELECT *, CASE WHEN epoch_us(event_timestamp) - epoch_us(lag(event_timestamp) OVER w)
        <= 1800000000 THEN 0 ELSE 1 END AS opens FROM steps WINDOW w AS
        (PARTITION BY session_id ORDER BY event_timestamp, event_id)),
      runs AS (SELECT *, sum(opens) OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS run
        FROM marked)
    SELECT session_id, count(*) FILTER (event_type = 'add_to_cart') AS cart_events,
      max(event_timestamp) FILTER (event_type = 'add_to_cart') AS last_cart,
      max(event_timestamp) + INTERVAL 30 MINUTE AS abandoned_at FROM runs GROUP BY session_id, run
    HAVING last_cart IS NOT NULL AND abandoned_at <= (SELECT max(event_timestamp) - INTERVAL 10 MINUTE FROM steps)
      AND coalesce(max(event_timestamp) FILTER (event_type = 'purchase') < last_cart, true)""", "s_events"))
def stream_cart_timer(s: Store):
    alarms = carts.cart_alarms(silver_events(event_stream(s)), 1800)
    return finished(s, "alarms", alarms, alarms.schema)


@query("stream_silent_windows", with_roles("""
    WITH slots AS (SELECT CAST(floor(epoch_us(event_timestamp) / 300000000) AS BIGINT) AS slot, event_type FROM s_events),
      spine AS (SELECT slot, event_type FROM (SELECT unnest(generate_series(min(slot), max(slot) + 12)) AS slot FROM slots),
        (SELECT unnest(['page_view', 'product_view', 'add_to_cart', 'checkout_start', 'purchase']) AS event_type)),
      counts AS (SELECT slot, event_type, count(*) AS n FROM slots GROUP BY 1, 2),
      filled AS (SELECT s.slot, s.event_type, coalesce(n, 0) AS n FROM spine s LEFT JOIN counts c
        ON s.slot = c.slot AND s.event_type = c.event_type),
      rolled AS (SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY slot ROWS 2 PRECEDING) AS lately FROM filled)
    SELECT make_timestamp(slot * 300000000) AS window_start, event_type, CAST(n AS BIGINT) AS event_count, lately = 0 AS outage
    FROM rolled WHERE n = 0 AND (slot + 1) * 300 <= (SELECT (max(slot) + 12) * 300 - 600 FROM slots)""", "s_events"))
def stream_silent_windows(s: Store):
    """Heartbeats every five minutes from the first event to an hour of silence after the last."""
    slot = F.floor(F.unix_micros(F.col("event_timestamp").cast("timestamp")) / 300_000_000)
    first, last = s.events().agg(F.min(slot), F.max(slot)).first()
    home = scratch_path(s.spark, "beats")
    ticks = s.spark.range(first, last + 13) if first is not None else s.spark.range(0)
    ticks.select(F.timestamp_seconds(F.col("id") * 300).alias("event_timestamp")).write.parquet(home)
    beats = s.spark.readStream.schema("event_timestamp timestamp").parquet(home)
    silent = outages.silent_windows(silver_events(event_stream(s)), beats, TYPES)
    return finished(s, "silent", silent, silent.schema)


@query("live_funnel", with_roles(f"""
    SELECT time_bucket(INTERVAL 1 HOUR, event_timestamp) AS window_start,
      count(*) FILTER (event_type = 'page_view') AS page_views,
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
    FROM s_events GROUP BY 1 HAVING window_start + INTERVAL 1 HOUR <= {_FINAL}""", "s_events"))
def live_funnel(s: Store):
    funnel = jobs.live_funnel(silver_events(event_stream(s)), "1 hour")
    return finished(s, "funnel", funnel, funnel.schema)
