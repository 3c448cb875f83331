"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from mercato.catalog.roles import SCHEMAS, Store
from mercato.lakehouse import Table
from mercato.operators import ingest, merge
from mercato.plans import gold
from mercato.schemas import ENTITIES
from mercato.sources import messages


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


# Runs that write before they answer have their own tests.
WRITING = {"csv_to_bronze", "medallion_funnel", "medallion_products", "scan_bytes"}
LAZY = sorted(n for n in entry.queries() if n not in WRITING and not n.startswith("stream_") and n != "live_funnel")


@pytest.mark.parametrize("name", LAZY)
def test_no_products_no_python(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval", "MapInPandas"):
        assert bad not in text, bad


def test_json_is_parsed_once(spark):
    bronze = spark.createDataFrame([("{}",)], "raw_data string")
    kept = merge.parse_bronze(bronze, ENTITIES["orders"], "2026-01-01").where("order_id is not null and status = 'x'")
    assert len(re.findall(r"__doc,StructType\(StructField\(\w+,StringType", optimized(kept))) == 1
    sent = messages.check_events(spark.createDataFrame([("{}",)], "value string"))
    assert len(re.findall(r"__doc,StructType\(StructField\(\w+,StringType", optimized(messages.valid_events(sent)))) == 1


def test_latest_row_is_picked_before_the_shuffle(spark, sf_dir):
    for name in ("latest_per_key", "top_products_by_category"):
        text = plan(entry.queries()[name](spark, sf_dir))
        assert re.search(r"WindowGroupLimit.*Partial", text), name


def test_date_ranges_reach_the_scan(spark, sf_dir):
    for name in ("orders_on_date", "reprocess_range", "retention_expired"):
        text = plan(entry.queries()[name](spark, sf_dir))
        assert re.search(r"PushedFilters: \[[^\]]*(LessThan|GreaterThan)", text), name


def test_only_used_columns_are_read(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = plan(gold.monthly_kpis(Store(spark, sf_dir).orders()))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"}


def test_outer_join_becomes_inner(spark, sf_dir):
    text = plan(entry.queries()["customer_metrics"](spark, sf_dir))
    assert "Inner" in text and "FullOuter" not in text


def test_day_filter_reads_one_partition(spark, lake):
    df = spark.createDataFrame([("o1", "2026-01-01"), ("o2", "2026-01-02")], "order_id string, d string")
    full = df.select("*", F.col("d").cast("timestamp").alias("ordered_at"))
    schema = lake.silver("orders").schema
    have = set(full.columns)
    lake.silver("orders").append(full.select(*[
        F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]))
    one = lake.table("silver", "orders", "2026-01-02", "2026-01-02")
    assert len(one.inputFiles()) == 1 and "ordered_at_date=2026-01-02" in one.inputFiles()[0]


def test_hot_keys_are_folded_before_the_shuffle(spark, sf_dir):
    """No window or join may see raw events of one visitor: an aggregate sits below every exchange on the key."""
    for name in ("user_sessions", "abandoned_carts", "event_gaps"):
        text = plan(entry.queries()[name](spark, sf_dir))
        lowest = text.rindex("Exchange hashpartitioning")
        assert "HashAggregate" in text[lowest:] or "ObjectHashAggregate" in text[lowest:], name


def test_small_incremental_source_is_broadcast(spark):
    target = spark.range(200_000).select(F.col("id").alias("k"), F.lit("x").alias("u"), F.lit(0).alias("processed_at"))
    source = target.limit(3)
    text = plan(merge.upsert(target, source, ["k"], ["u"], small_source=True))
    assert "FullOuter" not in text


def test_reprocess_includes_both_ends(spark):
    df = spark.createDataFrame([("2026-01-01 00:00:00",), ("2026-01-02 23:59:59",), ("2026-01-03 00:00:00",)], "t string").select(
        F.col("t").cast("timestamp").alias("ingested_at"))
    assert ingest.reprocess_range(df, "2026-01-01", "2026-01-02").count() == 2


def test_recent_rows_leave_out_the_boundary(spark):
    df = spark.sql("select timestamp'2026-01-01 11:45:00' as ingested_at union all select timestamp'2026-01-01 11:45:00.000001'")
    assert ingest.recent_rows(df, "15 minutes", now="2026-01-01 12:00:00").count() == 1


def test_medallion_products_loads_bronze_without_a_shuffle(spark, tmp_path, monkeypatch):
    own = {
        "part": [(1, "one", "B", "T", 1, 9.5), (2, None, None, "T", None, None)],
        "lineitem": [(7, 1, 3, 1, 2.0, 10.0, 0.1, 0.0, "N", "O", None), (7, 1, 4, 1, 3.0, 11.0, 0.1, 0.0, "N", "O", None),
                     (8, 1, 3, 1, 1.0, 5.25, 0.0, 0.0, "N", "O", None), (None, 2, 3, 1, 1.0, None, 0.0, 0.0, "N", "O", None)],
        "events": [(4, None, 1, "view", 0.0, None), (5, None, 1, "view", 0.0, None), (5, None, 1, "view", 0.0, None)],
    }
    for name, some in own.items():
        spark.createDataFrame(some, SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    frame, write, hints, shuffled = type(spark.range(1)), Table._write, [], {}
    hint = frame.hint

    def watched(self, df, *how):
        hints.clear()
        done = write(self, df, *how)
        shuffled["/".join(self.path.rsplit("/", 2)[1:])] = bool(hints)
        return done

    monkeypatch.setattr(frame, "hint", lambda self, *how: hints.append(how) or hint(self, *how))
    # One after the other, so that a hint belongs to the write that watches.
    monkeypatch.setattr("mercato.plans.medallion.bronze_to_silver", lambda lake, names, **how: [
        merge.merge_into(lake, n, **how) for n in ("products", "order_items", "reviews")])
    monkeypatch.setattr(Table, "_write", watched)
    found = entry.queries()["medallion_products"](spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == [
        ("1", "one", "T", 32.5, 8, 2, 3.0, 2), ("2", None, "T", 0.0, 1, 0, None, 0)]
    assert shuffled == {"bronze/products_raw": False, "bronze/order_items_raw": False, "bronze/reviews_raw": False,
                        "silver/products": True, "silver/order_items": True, "silver/reviews": True}
