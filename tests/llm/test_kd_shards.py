import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from mercato.llm.kd_shards import kd_shards
from mercato.llm.shard_queries import SHARDS, kd_tree_shards


def slots_are_gapless(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    return all(sorted(s) == list(range(len(s))) for s in by.values())


def bytes_of(rows):
    by = defaultdict(int)
    for r in rows:
        by[r["shard"]] += r["size"]
    return [by[i] for i in range(max(by) + 1)]


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = kd_tree_shards(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts) and slots_are_gapless(rows)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "bytes", None)
    sums, largest = bytes_of(rows), max(r["size"] for r in rows)
    assert len(sums) == SHARDS and max(sums) - min(sums) <= 2 * largest


@pytest.mark.parametrize("shards", [1, 3, 7, 16])
def test_a_hot_value_and_copies_are_parted(spark, documents, shards):
    """Two thirds of the rows have one value in every dimension, a third is one text."""
    rnd = random.Random(6)
    docs = documents([(i if i % 3 else 1, "copy of one text" if i % 3 == 0 else "t" * rnd.randrange(40), "en", "hot" if i % 3 < 2 else f"s{i % 11}")
                      for i in range(3000)])
    rows = kd_shards(docs, {"source": F.length("source"), "doc": F.col("doc_id")}, shards=shards).collect()
    sums = bytes_of(rows)
    assert len(rows) == 3000 and len(sums) == shards and slots_are_gapless(rows)
    assert max(sums) <= 1.02 * sum(sums) / shards + 41


def test_leaves_reach_the_target(spark, documents):
    docs = documents([(i, "x" * (i % 50), "en", "a") for i in range(800)] + [(900, "y" * 5000, "en", "a")])
    rows = kd_shards(docs, {"doc": F.col("doc_id"), "length": F.length("text")}, target_bytes=2000).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["size"])
    assert len(rows) == 801 and all(sum(s) <= 2000 or len(s) == 1 for s in by.values()) and sorted(by) == list(range(len(by)))


def test_awkward_rows(awkward, nothing):
    rows = kd_shards(awkward, {"doc": F.col("doc_id"), "none": F.lit(None).cast("double"), "nan": F.lit(float("nan"))}, shards=4).collect()
    assert len(rows) == awkward.count() and slots_are_gapless(rows)
    assert all((r["size"], r["text_crc32"]) == (1, 0) for r in rows if r["doc_id"] in (1, 2))
    assert kd_shards(nothing, {"doc": F.col("doc_id")}, shards=4).count() == 0
    assert kd_shards(nothing, {"doc": F.col("doc_id")}, target_bytes=9).count() == 0
    with pytest.raises(ValueError):
        kd_shards(nothing, {"doc": F.col("doc_id")})
