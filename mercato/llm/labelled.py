"""Rows to learn from: labels outside the held-out fold, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """One document in five, by crc32 of the id as text. A null id is never held out, nor learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def sample(labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, label) of at most `most` documents to learn from, the same ones whenever the table is the same.

    Several labels of one document count as their largest; null ids and labels are left out.
    """
    own = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    one = own.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
