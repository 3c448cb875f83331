"""Secrets in documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.llm.catalog import query
from mercato.llm.secrets import scan
from mercato.llm.store import table


@query("op9_secret_scan")
def secret_scan(spark, sf_dir):
    """Every candidate with its verdict; the value itself leaves only as a digest."""
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"),
        F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), "score", "secret")
