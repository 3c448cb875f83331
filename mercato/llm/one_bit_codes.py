"""Nearest neighbours by randomly rotated one-bit codes.

A vector less the centre, as a direction, is turned by a random rotation; the signs of its components are its code. With u
the unit vector those signs stand for, <u, direction> is kept as the correction scalar, beside the distance to the centre.
For a query <u, query> / <u, direction> estimates their inner product without bias, and its error is, but for a chance that
shrinks with exp(-BOUND^2), at most BOUND * sqrt(1 / <u, direction>^2 - 1) / sqrt(d - 1). So each estimate comes with a
bound below the true distance: candidates whose bound is over the k-th best exact distance are never opened.

Queries and candidates meet in blocks: a grid of hashed query blocks times hashed candidate blocks, each cell one task's
bounded work, whose k best per query go on to the merge.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.store import saved

#: Rows that the centre is taken from, chosen by hash of the id. It moves no result but through the width of the bounds.
CENTRE_ROWS = 4096
#: Standard errors of the bound below the true distance.
BOUND = 3.0
#: Expected rows of a block of candidates and of queries.
CANDIDATES, QUERIES = 8192, 4096
SEED = 20

INDEX = "vec_id long, size int, vector array<double>, code binary, length double, along double"


def usable(vector: Column) -> Column:
    """Not null, not zero, no component null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix, the same one for the same size."""
    made, upper = np.linalg.qr(np.random.default_rng([SEED, size]).normal(size=(size, size)))
    return made * np.where(np.diag(upper) < 0, -1.0, 1.0)


def vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, size, vector) of usable rows; of several of one id the least vector."""
    own = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    one = own.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"))).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return one.select("vec_id", F.size("vector").alias("size"), "vector")


def centres(rows: DataFrame) -> dict[int, np.ndarray]:
    """Mean vector per size over CENTRE_ROWS rows at most; sizes that the sample misses have none."""
    held: dict[int, list] = {}
    for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CENTRE_ROWS).collect():
        held.setdefault(r["size"], []).append(r["vector"])
    with np.errstate(over="ignore"):
        means = {size: np.mean(np.array(v), axis=0) for size, v in held.items()}
    return {size: m for size, m in means.items() if np.isfinite(m).all()}


def indexed(rows: DataFrame, around: dict[int, np.ndarray]) -> DataFrame:
    """Every vector with its packed signs, its distance to the centre and the correction scalar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                size = int(size)
                turn = turns.setdefault(size, rotation(size))
                given = part.column(2).flatten().to_numpy().reshape(-1, size)
                off = given - around.get(size, 0.0)
                length = np.linalg.norm(off, axis=1)
                turned = (off / np.where(length > 0, length, 1.0)[:, None]) @ turn
                code = np.packbits(turned > 0, axis=1)
                along = np.where(length > 0, np.abs(turned).sum(axis=1) / math.sqrt(size), 1.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(length), pa.array(along)],
                    ["vec_id", "size", "vector", "code", "length", "along"])

    return rows.mapInArrow(run, INDEX)


def tables(query: np.ndarray) -> np.ndarray:
    """For each byte of a code and each of its values, the part of <signs, query> that its eight signs give."""
    padded = np.zeros(-(-len(query) // 8) * 8)
    padded[:len(query)] = query
    signs = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) * 2.0 - 1.0
    return padded.reshape(-1, 8) @ signs.T


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances, squares added in the order of the components."""
    total = np.zeros(len(vectors))
    with np.errstate(over="ignore"):
        for j in range(len(query)):
            off = vectors[:, j] - query[j]
            total += off * off
    return np.sqrt(total)


def nearest(query_id: int, query: np.ndarray, turned: np.ndarray, away: float, k: int, ids: np.ndarray, given: np.ndarray,
            codes: np.ndarray, length: np.ndarray, along: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact distances of the k nearest of a block to a query, `away` its distance from the centre, `turned` its direction."""
    size = len(query)
    guess = np.zeros(len(ids))
    for place, parts in enumerate(tables(turned)):
        guess += parts[codes[:, place]]
    guess /= math.sqrt(size) * along
    slack = BOUND * np.sqrt(np.maximum(1 / (along * along) - 1, 0)) / math.sqrt(max(1, size - 1))
    with np.errstate(over="ignore", invalid="ignore"):
        base, both = length * length + away * away, 2 * length * away
        estimate, least = base - both * guess, base - both * np.minimum(guess + slack, 1)
    other = ids != query_id
    at = np.flatnonzero(other)
    if len(at) > k:
        at = at[np.argpartition(estimate[at], k - 1)[:k]]
    if not len(at):
        return ids[:0], estimate[:0]
    limit = exact(given[at], query).max()
    opened = np.flatnonzero(other & ~(least > limit * limit * (1 + 1e-9) + 1e-12 * (base + both)))
    found = exact(given[opened], query)
    best = np.lexsort((ids[opened], found))[:k]
    return ids[opened][best], found[best]


def _meet(k: int, around: dict[int, np.ndarray]):
    def arrays(rows: pa.Table) -> tuple:
        given = rows.column("vector").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
        codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(rows.num_rows, -1)
        return rows.column("vec_id").to_numpy(), given, codes, rows.column("length").to_numpy(), rows.column("along").to_numpy()

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out_query, out_id, out_score = [], [], []
        if queries.num_rows and candidates.num_rows:
            size = queries.column("size")[0].as_py()
            held = arrays(candidates)
            asked = queries.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, size)
            off = asked - around.get(size, 0.0)
            away = np.linalg.norm(off, axis=1)
            turned = (off / np.where(away > 0, away, 1.0)[:, None]) @ rotation(size)
            for i, query_id in enumerate(queries.column("vec_id").to_pylist()):
                ids, scores = nearest(query_id, asked[i], turned[i], away[i], k, *held)
                out_query.append(np.full(len(ids), query_id))
                out_id.append(ids)
                out_score.append(scores)
        return pa.table({name: pa.array(np.concatenate(parts) if parts else [], kind) for name, parts, kind in (
            ("query_id", out_query, pa.int64()), ("vec_id", out_id, pa.int64()), ("score", out_score, pa.float64()))})

    return run


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("vec_id"), F.lit(blocks))


def _each(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))


def search(rows: DataFrame, asked: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other vectors to each vector whose `vec_id` meets `asked`.

    Nearest by Euclidean distance, which is the score, computed on the vectors as given; ties go to the smaller id; all
    candidates if there are fewer than k. Vectors meet those of their own size only. Rows without an id and vectors that are
    null, empty, zero or hold null, NaN or infinite components take no part; rows of one id count as the least of their
    vectors. Every vector is coded and estimated against every query; other columns are ignored. An empty table gives no row.
    """
    own = saved(vectors(rows, id_col, vector_col), "vectors")
    around = centres(own)
    index = saved(indexed(own, around), "codes")
    queries = index.filter(asked)
    across, down = max(1, -(-queries.count() // QUERIES)), max(1, -(-index.count() // CANDIDATES))
    left = queries.withColumn("row", _block(across)).withColumn("col", _each(down))
    right = index.withColumn("col", _block(down)).withColumn("row", _each(across))
    cell = ["size", "row", "col"]
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(
        _meet(k, around), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
