"""Documents in shards of equal bytes."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.llm.catalog import query
from mercato.llm.kd_shards import kd_shards
from mercato.llm.store import table

SHARDS = 16


def spread(column: str):
    """A place in [0, 1) for each value of a name."""
    return F.pmod(F.xxhash64(column), F.lit(1 << 20)) / (1 << 20)


@query("op6_kd_shards")
def kd_tree_shards(spark, sf_dir):
    length = F.log2(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)
    made = kd_shards(table(spark, sf_dir, "documents"), {
        "length": length, "doc_id": F.col("doc_id"), "lang": spread("lang"), "source": spread("source")}, shards=SHARDS)
    return made.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))
