"""Declared tables: one EntitySpec per Silver entity, plus the Bronze shapes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING, DOUBLE, LONG, BOOL, TS = "string", "double", "long", "boolean", "timestamp"

BRONZE_SCHEMA = T.StructType([
    T.StructField("record_id", T.StringType(), False),
    T.StructField("raw_data", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
])
BRONZE_EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("event_type", T.StringType()),
    T.StructField("raw_payload", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
])
EVENTS_ERRORS_SCHEMA = T.StructType([
    T.StructField("raw_message", T.StringType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("error_detail", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("error_timestamp", T.TimestampType()),
])
INGESTION_LOG_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("file_size", T.LongType()),
    T.StructField("file_mtime", T.TimestampType()),
    T.StructField("rows", T.LongType()),
    T.StructField("ingested_at", T.TimestampType()),
])
EVENT_METRICS_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_count", T.LongType()),
    T.StructField("calculated_at", T.TimestampType()),
])


@dataclass(frozen=True)
class EntitySpec:
    """How one entity is parsed from Bronze and merged into Silver.

    ``fields`` maps a Silver column to (JSON field, type); ``carried`` names
    columns Bronze already holds outside the JSON text.
    """

    name: str
    keys: tuple[str, ...]
    fields: tuple[tuple[str, str, str], ...]
    update: tuple[str, ...] = ()
    partition: str | None = None
    cluster: tuple[str, ...] = ()
    carried: tuple[str, ...] = ()
    after: tuple[str, ...] = ()

    @property
    def bronze_table(self) -> str:
        return f"{self.name}_raw"

    @property
    def json_column(self) -> str:
        return "raw_payload" if self.carried else "raw_data"

    @property
    def bronze_schema(self) -> T.StructType:
        return BRONZE_EVENTS_SCHEMA if self.carried else BRONZE_SCHEMA

    @property
    def insert_only(self) -> bool:
        return not self.update

    @property
    def columns(self) -> tuple[str, ...]:
        return self.carried + tuple(f[0] for f in self.fields)

    @property
    def partition_column(self) -> str | None:
        return f"{self.partition}_date" if self.partition else None

    @property
    def silver_schema(self) -> T.StructType:
        kinds = {STRING: T.StringType(), DOUBLE: T.DoubleType(), LONG: T.LongType(),
                 BOOL: T.BooleanType(), TS: T.TimestampType()}
        types = {c: STRING for c in self.carried} | {f[0]: f[2] for f in self.fields}
        out = [T.StructField(c, kinds[types[c]], c not in self.keys) for c in self.columns]
        out.append(T.StructField("processed_at", T.TimestampType()))
        return T.StructType(out)


def _same(kind: str, *names: str) -> tuple[tuple[str, str, str], ...]:
    return tuple((n, n, kind) for n in names)


ENTITIES: dict[str, EntitySpec] = {
    s.name: s
    for s in (
        EntitySpec(
            name="customers",
            keys=("customer_id",),
            fields=(("customer_id", "id", STRING),)
            + _same(STRING, "email", "first_name", "last_name", "phone", "country", "city", "address")
            + _same(TS, "created_at", "updated_at"),
            update=("email", "first_name", "last_name", "phone", "country", "city", "address", "updated_at"),
            cluster=("country", "city"),
        ),
        EntitySpec(
            name="products",
            keys=("product_id",),
            fields=(("product_id", "id", STRING),)
            + _same(STRING, "name", "description", "category", "subcategory")
            + _same(DOUBLE, "price")
            + _same(STRING, "currency", "sku")
            + _same(BOOL, "is_active")
            + _same(TS, "created_at"),
            update=("name", "description", "price", "is_active"),
            cluster=("category", "subcategory"),
        ),
        EntitySpec(
            name="orders",
            keys=("order_id",),
            fields=_same(STRING, "order_id", "customer_id", "status")
            + _same(DOUBLE, "total_amount")
            + _same(STRING, "currency", "shipping_address", "shipping_city", "shipping_country")
            + _same(TS, "ordered_at", "shipped_at", "delivered_at"),
            update=("status", "shipped_at", "delivered_at"),
            partition="ordered_at",
            cluster=("status", "shipping_country"),
            after=("customers",),
        ),
        EntitySpec(
            name="order_items",
            keys=("order_item_id",),
            fields=_same(STRING, "order_item_id", "order_id", "product_id")
            + _same(LONG, "quantity")
            + _same(DOUBLE, "unit_price", "total_price", "discount"),
            cluster=("product_id",),
            after=("orders", "products"),
        ),
        EntitySpec(
            name="payments",
            keys=("payment_id",),
            fields=_same(STRING, "payment_id", "order_id", "customer_id")
            + _same(DOUBLE, "amount")
            + _same(STRING, "currency", "payment_method", "status")
            + _same(TS, "paid_at"),
            update=("status",),
            partition="paid_at",
            cluster=("payment_method", "status"),
            after=("orders",),
        ),
        EntitySpec(
            name="events",
            keys=("event_id",),
            carried=("event_id", "event_type"),
            fields=_same(STRING, "customer_id", "session_id", "product_id", "search_query", "page_url", "device")
            + (("event_timestamp", "timestamp", TS),),
            partition="event_timestamp",
            cluster=("event_type", "customer_id", "device"),
        ),
        EntitySpec(
            name="inventory",
            keys=("product_id", "warehouse"),
            fields=_same(STRING, "product_id", "warehouse")
            + _same(LONG, "quantity_available", "quantity_reserved")
            + _same(TS, "last_updated"),
            update=("quantity_available", "quantity_reserved", "last_updated"),
            cluster=("warehouse",),
        ),
        EntitySpec(
            name="reviews",
            keys=("review_id",),
            fields=_same(STRING, "review_id", "product_id", "customer_id")
            + _same(LONG, "rating")
            + _same(STRING, "title", "comment")
            + _same(TS, "created_at"),
            partition="created_at",
            cluster=("product_id", "rating"),
        ),
    )
}

# Domains of the store's data.
ORDER_STATUSES = ("pending", "processing", "shipped", "delivered", "completed", "cancelled")
PAID_STATUSES = ("completed", "delivered")
EVENT_TYPES = ("page_view", "product_view", "search", "add_to_cart", "remove_from_cart",
               "checkout_start", "purchase")
PAYMENT_STATUSES = ("completed", "failed", "refunded")
