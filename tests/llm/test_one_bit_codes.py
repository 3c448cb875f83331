import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import one_bit_codes
from mercato.llm.one_bit_codes import centres, indexed, nearest, rotation, search, vectors
from mercato.llm.vector_queries import one_bit_search

SCHEMA = "vec_id long, embedding array<double>, code string, size string, row long, score string"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, "c", "s", 1, "t") for i, v in rows], SCHEMA)


def sound(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, step, k):
    own = {}
    for i, v in rows:
        if i is not None and v is not None and sound(v):
            own[i] = min(own.get(i, v), v)
    out = {}
    for q in (i for i in own if i % step == 0):
        far = sorted((math.sqrt(sum((x - y) ** 2 for x, y in zip(v, own[q]))), i) for i, v in own.items() if i != q and len(v) == len(own[q]))
        out[q] = [(i, d) for d, i in far[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("blocks", [(8192, 4096), (30, 3)])
def test_recall_and_scores(spark, monkeypatch, blocks):
    monkeypatch.setattr(one_bit_codes, "CANDIDATES", blocks[0])
    monkeypatch.setattr(one_bit_codes, "QUERIES", blocks[1])
    rnd = np.random.default_rng(6)
    middles = rnd.normal(size=(5, 24))
    rows = [(i, (middles[i % 5] + rnd.normal(scale=0.4, size=24)).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 400)]  # one vector in a quarter of the rows
    got, want = found(search(table_of(spark, rows), F.col("vec_id") % 10 == 0, 10)), brute(rows, 10, 10)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.98 * sum(map(len, want.values()))
    exact = dict(rows)
    for q, near in got.items():
        assert all(d == pytest.approx(math.dist(exact[i], exact[q]), abs=1e-12) for i, d in near)
        assert near == sorted(near, key=lambda x: (x[1], x[0]))


def test_bounds_leave_most_vectors_unopened(spark, monkeypatch):
    rnd = np.random.default_rng(1)
    middles = rnd.normal(size=(20, 64)) * 2
    rows = [(i, (middles[i % 20] + rnd.normal(scale=0.3, size=64)).tolist()) for i in range(2000)]
    own = vectors(table_of(spark, rows), "vec_id", "embedding")
    around = centres(own)
    held = sorted(indexed(own, around).collect(), key=lambda r: r["vec_id"])
    opened, plain = [], one_bit_codes.exact
    monkeypatch.setattr(one_bit_codes, "exact", lambda v, q: opened.append(len(v)) or plain(v, q))
    args = (np.array([r["vec_id"] for r in held]), np.array([r["vector"] for r in held]),
            np.frombuffer(b"".join(r["code"] for r in held), np.uint8).reshape(2000, 8),
            np.array([r["length"] for r in held]), np.array([r["along"] for r in held]))
    for i in range(0, 2000, 100):
        query = np.array(rows[i][1])
        off = query - around[64]
        away = np.linalg.norm(off)
        nearest(i, query, off / away @ rotation(64), away, 10, *args)
    assert sum(opened) < 0.2 * 20 * 2000


def test_a_rotation_keeps_lengths():
    for size in (1, 2, 64):
        assert np.allclose(rotation(size) @ rotation(size).T, np.eye(size))


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (10, [1.0, 2.0]), (11, [1.0, 2.0]), (11, [1.0, 2.0]), (20, [5.0]), (21, [-4.0]), (30, None), (40, []), (50, [0.0, 0.0]),
            (60, [nan, 1.0]), (70, [inf, 1.0]), (80, [None, 1.0]), (None, [1.0, 2.0]), (12, [9.0, 9.0]), (12, [1.0, 3.0]),
            (90, [1.0, 2.0, 3.0]), (100, [1e200, 1.0]), (13, [-1e308, 4.0])]
    got = found(search(table_of(spark, rows), F.col("vec_id") % 10 == 0, 10))
    want = {q: near for q, near in brute([(i, v) for i, v in rows if i not in (100, 13)], 10, 10).items() if near}
    for q in (0, 10):
        assert [x for x in got[q] if x[0] not in (100, 13)] == want[q]
    assert got[20] == [(21, 9.0)] and set(got) == {0, 10, 20, 100}
    assert search(table_of(spark, []), F.col("vec_id") % 10 == 0, 10).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got, want = found(one_bit_search(spark, sf_dir)), brute(rows, 100, 10)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert got.keys() == want.keys() and hits >= 0.98 * sum(map(len, want.values()))
