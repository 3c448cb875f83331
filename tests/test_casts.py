from datetime import datetime

import pytest
from pyspark.sql import functions as F

from mercato.functions import casts


@pytest.mark.parametrize("kind, text, want", [
    ("timestamp", "2026-01-05T10:00:00Z", datetime(2026, 1, 5, 10)),
    ("timestamp", "2026-01-05T10:00:00.5+00:00", datetime(2026, 1, 5, 10, 0, 0, 500000)),
    ("timestamp", "2026-01-05T10:00:00+02:00", datetime(2026, 1, 5, 8)),
    ("timestamp", "2026-01-05", datetime(2026, 1, 5)),
    ("timestamp", "", None), ("timestamp", "2026", None), ("timestamp", "2026-02", None),
    ("timestamp", "soon", None), ("timestamp", None, None),
    ("double", "12.50", 12.5), ("double", "-1e3", -1000.0), ("double", ".5", 0.5), ("double", "1d", None),
    ("double", "12,5", None), ("double", "", None),
    ("long", "12", 12), ("long", " 12 ", 12), ("long", "12.5", None), ("long", "x", None),
    ("boolean", "TRUE", True), ("boolean", "false", False), ("boolean", "yes", None), ("boolean", "1", None),
])
def test_safe_casts(spark, kind, text, want):
    df = spark.createDataFrame([(text,)], "x string").select(casts.cast_text(F.col("x"), kind).cast(
        "timestamp_ntz" if kind == "timestamp" else kind).alias("y"))
    assert df.first().y == want


def test_strict_casts_raise(spark):
    df = spark.createDataFrame([("12.5",)], "x string")
    with pytest.raises(Exception, match="not a long: 12.5"):
        df.select(casts.cast_text(F.col("x"), "long", strict=True)).collect()
    assert spark.createDataFrame([("7",), (None,)], "x string").select(
        casts.cast_text(F.col("x"), "long", strict=True).alias("y")).collect()[0].y == 7


def test_money_does_not_depend_on_order(spark):
    values = [(0.1,), (0.2,), (0.3,), (1e9,), (-1e9,)]
    total = spark.createDataFrame(values, "x double").agg(casts.money_sum(F.col("x")).cast("double")).first()[0]
    assert total == 0.6
