"""Centroid clustering of integer vectors, with centroids ruled out by a lower bound in rotated coordinates.

Each vector is stored with its leading coordinates on the principal axes and the norm of what they leave out. For a centroid
given in the same way, the squared distance of the leading coordinates plus the squared difference of the two norms is never
over the true squared distance. Centroids whose bound is over the exact distance of the likeliest one are ruled out; the
others are compared in integers, so the rotation, done in floating point, moves no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.store import saved

SCALE = 64
LEADING = 16
#: Components from this size on could make a squared distance that a long cannot hold.
MOST = 1 << 27
#: Share of the squared norms that floating point may be wrong by, with room to spare.
DOUBT = 1e-9


def whole(rows: DataFrame, size: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x) of vectors of `size` components, none null or not finite; x as integers floor(SCALE * component)."""
    own = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < MOST / SCALE))
    return own.filter((F.size("v") == size) & F.coalesce(sound, F.lit(False))).select(
        "vec_id", F.transform("v", lambda x: F.floor(x * SCALE).cast("int")).alias("x"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, size)


def principal(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and leading axes (columns) of all rows, from sums and sums of products added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            x = np.ones((batch.num_rows, size + 1))
            x[:, :size] = _matrix(batch.column(0), size)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1, dtype=np.int32)), pa.array(total.tolist())], ["i", "sums"])

    parts = rows.select("x").mapInArrow(run, "i int, sums array<double>")
    got = parts.groupBy("i").agg(F.array(*[F.sum(F.col("sums")[j]) for j in range(size + 1)]).alias("sums")).orderBy("i").collect()
    total = np.array([r["sums"] for r in got])
    n = total[size, size]
    mean = total[size, :size] / n
    return mean, np.linalg.eigh(total[:size, :size] / n - np.outer(mean, mean))[1][:, ::-1][:, :LEADING]


def placed(x: np.ndarray, mean: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates, and the norm of what they leave out."""
    off = x - mean
    lead = off @ axes
    return lead, np.linalg.norm(off - lead @ axes.T, axis=1)


def stored(rows: DataFrame, mean: np.ndarray, axes: np.ndarray) -> DataFrame:
    """rows with `lead` and `rest`, once for all rounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead, rest = placed(_matrix(batch.column(1), len(mean)), mean, axes)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.FixedSizeListArray.from_arrays(pa.array(lead.ravel()), lead.shape[1]).cast(pa.list_(pa.float64())),
                 pa.array(rest)], ["vec_id", "x", "lead", "rest"])

    return rows.mapInArrow(run, "vec_id long, x array<int>, lead array<double>, rest double")


def assign(x: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, at: tuple[np.ndarray, np.ndarray]) -> tuple:
    """Number and squared distance of the nearest centroid of every row, ties to the smaller number, and pairs compared exactly."""
    centre_lead, centre_rest = at
    own = (lead * lead).sum(axis=1)[:, None] + (centre_lead * centre_lead).sum(axis=1)[None, :]
    bound = own - 2 * lead @ centre_lead.T + (rest[:, None] - centre_rest[None, :]) ** 2
    doubt = DOUBT * (1 + own + rest[:, None] ** 2 + centre_rest[None, :] ** 2)

    def squared(rows: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        off = x[rows].astype(np.int64) - centroids[numbers]
        return (off * off).sum(axis=1)

    everyone = np.arange(len(x))
    best = bound.argmin(axis=1)
    least, opened = squared(everyone, best), len(x)
    limit = least.astype(np.float64)
    for number in range(len(centroids)):
        rows = np.flatnonzero((bound[:, number] <= limit + doubt[:, number]) & (best != number))
        far = squared(rows, np.full(len(rows), number))
        nearer = (far < least[rows]) | ((far == least[rows]) & (number < best[rows]))
        best[rows[nearer]], least[rows[nearer]] = number, far[nearer]
        opened += len(rows)
    return best, least, opened


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, mean: np.ndarray, axes: np.ndarray) -> tuple:
    x = _matrix(batch.column("x"), len(mean))
    return x, assign(x, _matrix(batch.column("lead"), axes.shape[1]), batch.column("rest").to_numpy(), centroids,
                     placed(centroids, mean, axes))


def moved(rows: DataFrame, centroids: np.ndarray, mean: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floor of the mean of each one's vectors; one without vectors stays."""
    size = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, (best, _, _) = _assigned(batch, centroids, mean, axes)
            met = np.unique(best)
            sums = np.array([x[best == c].sum(axis=0, dtype=np.int64) for c in met]).reshape(-1, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(met, pa.int32()), pa.array(np.array([(best == c).sum() for c in met], np.int64)),
                 pa.array(sums.tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    parts = rows.mapInArrow(run, "cluster int, n long, sums array<long>")
    added = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[j].cast("decimal(38,0)")) for j in range(size)]).alias("sums"))
    after = centroids.copy()
    for r in added.collect():
        after[r["cluster"]] = [int(s) // r["n"] for s in r["sums"]]
    return after


def clusters(rows: DataFrame, size: int, count: int, rounds: int, start_key: Column, id_col: str = "vec_id",
             vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) of every vector of `size` sound components.

    The first centroids are the `count` vectors with the least `start_key` (by the column vec_id; ties to the lesser vector),
    fewer if there are fewer; a row without an id is no start but belongs to a cluster. Vectors of another size, null ones,
    and those with null, NaN, infinite components or components of 2^21 and more take no part. Repeated rows count each;
    other columns are ignored; an empty table gives no row. A sum of distances beyond a long is null.
    """
    kept = saved(whole(rows, size, id_col, vector_col), "whole")
    first = kept.filter("vec_id is not null").orderBy(start_key, "x").limit(count).collect()
    centroids = np.array([r["x"] for r in first], np.int64).reshape(-1, size)
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<int>"
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], out)
    mean, axes = principal(kept, size)
    ready = saved(stored(kept, mean, axes), "rotated")
    for _ in range(rounds):
        centroids = moved(ready, centroids, mean, axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, (best, least, _) = _assigned(batch, centroids, mean, axes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.int32()), pa.array(least)], ["vec_id", "cluster", "distance"])

    last = saved(ready.mapInArrow(run, "vec_id long, cluster int, distance long"), "clusters")
    sums = last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    fits = [s if s < 1 << 63 else None for s in (sum(int(r["s"]) for r in sums), *[int(r["s"]) for r in sums])]
    of_cluster = [(r["cluster"], s, fits[0], centroids[r["cluster"]].tolist()) for r, s in zip(sums, fits[1:])]
    known = rows.sparkSession.createDataFrame(of_cluster, "cluster int, cluster_inertia long, inertia long, centroid array<int>")
    return last.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
