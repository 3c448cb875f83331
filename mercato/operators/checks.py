"""Counts, duplicates, quality rules and alerts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.casts import money_sum
from mercato.functions.instants import bucket_start, time_bucket
from mercato.schemas import ORDER_STATUSES, PAYMENT_STATUSES


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, by name."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def counts_by_source(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(F.count("*").alias("row_count"))


def duplicate_sources(rows: DataFrame) -> DataFrame:
    """Sources with more than one row, by the plain HAVING rule: any file with two rows qualifies; see duplicate_loads."""
    return counts_by_source(rows).where("row_count > 1")


def duplicate_loads(bronze: DataFrame) -> DataFrame:
    """Records that one source brought more than once."""
    return bronze.groupBy("source", "record_id").agg(F.count("*").alias("copies")).where("copies > 1")


def latest_ingested(rows: DataFrame, n: int, time: str, tiebreak: str) -> DataFrame:
    """The ``n`` newest rows; each task keeps its own ``n`` first."""
    return rows.orderBy(F.desc(time), F.desc(tiebreak)).limit(n)


def error_summary(errors: DataFrame) -> DataFrame:
    return errors.groupBy("error_type").agg(F.count("*").alias("errors"))


def error_alerts(errors: DataFrame, seconds: int = 600, above: int = 0, time: str = "error_timestamp") -> DataFrame:
    """Slots with more than ``above`` errors."""
    return errors.groupBy(time_bucket(F.col(time), seconds).alias("slot")).agg(
        F.count("*").alias("errors")).where(F.col("errors") > above).select(
        bucket_start(F.col("slot"), seconds).alias("window_start"), "errors")


def bytes_scanned(df: DataFrame) -> DataFrame:
    """Files and bytes a read touches; only file metadata is looked at."""
    files = df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    return files.distinct().agg(F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


def scan_bytes(full: DataFrame, filtered: DataFrame) -> DataFrame:
    """Bytes of the whole table against those left by the filter."""
    return bytes_scanned(full).select(F.lit("full").alias("scan"), "files", "bytes").unionByName(
        bytes_scanned(filtered).select(F.lit("filtered").alias("scan"), "files", "bytes"))


# ---- quality rules


def _failures(table: str, df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """All row rules of a table in one pass."""
    one = df.agg(*[F.count_if(bad).alias(rule) for rule, bad in rules.items()])
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("failures")) for r in rules])
    return one.select(F.lit(table).alias("table_name"), F.inline(rows))


def _duplicates(table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    extra = df.groupBy(*keys).agg((F.count("*") - 1).alias("extra"))
    return extra.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit("unique_key").alias("rule"), "failures")


def _orphans(table: str, df: DataFrame, key: str, parent: DataFrame) -> DataFrame:
    """Rows whose parent is missing; children are counted per key before they are compared."""
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return per_key.join(parent.select(key), key, "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit(f"{key}_exists").alias("rule"), "failures")


def quality_report(silver: Mapping[str, DataFrame], tolerance: float = 0.01) -> DataFrame:
    """Failing rows per table and rule, for the tables given."""
    c = F.col
    row_rules = {
        "customers": {"key_present": c("customer_id").isNull()},
        "products": {"key_present": c("product_id").isNull(), "price_not_negative": c("price") < 0},
        "orders": {
            "key_present": c("order_id").isNull(),
            "status_known": ~F.coalesce(c("status").isin(*ORDER_STATUSES), F.lit(False)),
            "shipped_after_ordered": c("shipped_at") < c("ordered_at"),
        },
        "order_items": {
            "key_present": c("order_item_id").isNull(),
            "quantity_positive": c("quantity") <= 0,
            "total_adds_up": F.abs(
                c("total_price") - F.round(c("quantity") * c("unit_price") - c("discount"), 2)) > tolerance,
        },
        "payments": {
            "key_present": c("payment_id").isNull(),
            "status_known": ~F.coalesce(c("status").isin(*PAYMENT_STATUSES), F.lit(False)),
        },
        "inventory": {
            "key_present": c("product_id").isNull() | c("warehouse").isNull(),
            "reserved_within_available": c("quantity_reserved") > c("quantity_available"),
        },
        "reviews": {
            "key_present": c("review_id").isNull(),
            "rating_in_range": ~F.coalesce(c("rating").between(1, 5), F.lit(False)),
        },
        "events": {"key_present": c("event_id").isNull(), "time_present": c("event_timestamp").isNull()},
    }
    keys = {"customers": ["customer_id"], "products": ["product_id"], "orders": ["order_id"],
            "order_items": ["order_item_id"], "payments": ["payment_id"], "events": ["event_id"],
            "inventory": ["product_id", "warehouse"], "reviews": ["review_id"]}
    parents = [("orders", "customer_id", "customers"), ("order_items", "order_id", "orders"),
               ("order_items", "product_id", "products"), ("payments", "order_id", "orders"),
               ("reviews", "product_id", "products"), ("inventory", "product_id", "products")]
    parts = []
    for name, df in silver.items():
        parts.append(_failures(name, df, row_rules[name]))
        parts.append(_duplicates(name, df, keys[name]))
    for child, key, parent in parents:
        if child in silver and parent in silver:
            parts.append(_orphans(child, silver[child], key, silver[parent]))
    return reduce(DataFrame.unionByName, parts)


def order_total_differences(orders: DataFrame, items: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Orders whose amount is not the sum of their items' totals: order_id, total_amount, items_total.

    An order without items, or without an amount, has none to compare and is left out.
    """
    sums = items.groupBy("order_id").agg(money_sum(F.col("total_price")).cast("double").alias("items_total"))
    return orders.select("order_id", "total_amount").join(sums, "order_id").where(
        F.abs(F.col("total_amount") - F.col("items_total")) > tolerance)
