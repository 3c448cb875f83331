import hashlib
import math

import numpy as np
import pytest

from mercato.llm.pca_clusters import LEADING, assign, placed
from mercato.llm.vector_queries import centroid_digests, pca_clusters


def brute(rows):
    own = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
           if v is not None and len(v) == 64 and all(x is not None and abs(x) < 1 << 21 for x in v)]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), x) for i, x in own if i is not None)
    centroids = [x for _, x in named[:16]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))

    for _ in range(3):
        members = {}
        for _, x in own:
            members.setdefault(nearest(x)[1], []).append(x)
        for n, held in members.items():
            centroids[n] = [sum(c) // len(held) for c in zip(*held)]
    last = [(i, *nearest(x)[::-1]) for i, x in own]
    inertia = {}
    for _, n, d in last:
        inertia[n] = inertia.get(n, 0) + d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), digests[n]) for i, n, d in last), key=repr)


def plain(df):
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, 3, "l", [1]) for i, v in rows], "vec_id long, embedding array<double>, cluster long, lead string, x array<int>")


def test_query_against_brute_force(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert plain(pca_clusters(spark, sf_dir)) == brute(rows)


def test_awkward_rows(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, rnd.normal(size=64).tolist()) for i in range(40)]
    rows += [(i, rows[3][1]) for i in range(40, 60)] + [rows[5], rows[5], (None, rows[6][1]), (None, rows[7][1])]
    rows += [(70, None), (71, []), (72, [1.0] * 63), (73, [None] + [1.0] * 63), (74, [float("nan")] * 64), (75, [float("inf")] * 64),
             (76, [3e6] * 64), (77, [0.0] * 64), (78, [-2097151.5] * 64), (79, [1e-300, -1e-300] * 32)]
    assert plain(centroid_digests(table_of(spark, rows))) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5] * 64)], [(None, [0.5] * 64)], [(1, [0.5] * 64)] * 20])
def test_few_rows(spark, rows):
    want = [] if rows and rows[0][0] is None else brute(rows)
    assert plain(centroid_digests(table_of(spark, rows))) == want


@pytest.mark.parametrize("scale", [3, 1 << 20, (1 << 27) - 1])
def test_bounds_rule_out_no_nearest_centroid(scale):
    rnd = np.random.default_rng(scale)
    x = rnd.integers(-scale, scale + 1, size=(3000, 64)).astype(np.int32)
    centroids = np.concatenate([x[:8], x[:4] + 1, x[:4]]).astype(np.int64)  # near ones and equal ones
    axes = np.linalg.qr(rnd.normal(size=(64, 64)))[0][:, :LEADING]
    mean = x.mean(axis=0)
    best, least, _ = assign(x, *placed(x, mean, axes), centroids, placed(centroids, mean, axes))
    far = ((x.astype(np.int64)[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (best == far.argmin(axis=1)).all() and (least == far.min(axis=1)).all()


def test_bounds_rule_out_most_centroids_of_clustered_rows():
    rnd = np.random.default_rng(8)
    middles = rnd.integers(-200, 200, size=(16, 64))
    x = (middles[np.arange(4000) % 16] + rnd.integers(-9, 10, size=(4000, 64))).astype(np.int32)
    mean = x.mean(axis=0)
    axes = np.linalg.eigh(np.cov(x.T))[1][:, ::-1][:, :LEADING]
    opened = assign(x, *placed(x, mean, axes), middles, placed(middles, mean, axes))[2]
    assert opened < 1.1 * len(x)
