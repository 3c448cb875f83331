"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

Statistics of a text are turned into a vector of four numbers. For every group of documents the minimum covariance
determinant is approached by concentration steps: from a start, the share H of the group's rows nearest to the present
centre gives the next centre and covariance, whose determinant can only shrink. Two starts are taken along, medians with
median deviations and plain means with covariances; per group the smaller determinant is kept. A row is an outlier if its
squared Mahalanobis distance is over a quantile of the chi-square distribution.

All rows that pass the fixed limits take part in every step, as sums of products per group with map-side sums and as
mergeable quantile sketches; a group's rows are never gathered. A group of under LEAST rows is pooled with the other such
groups of its language, and if these are few as well, with those of all languages.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.store import saved
from mercato.llm.text_stats import counted

LEAST_WORDS, MOST_REPEATED = 50, 50
LEAST = 100
STEPS = 8
STILL = 0.001
#: Least spread of each number: a constant statistic does not make every other value an outlier.
FLOORS = (0.08, 0.5, 0.35, 0.9)
SIZE = len(FLOORS)
#: The usual half sample, (n + SIZE + 1) / 2 of n rows, as a share of the smallest group. A third of a group may be
#: copies of one bad text; 45% of identical vectors are nearly a half sample of their own and are kept.
H = 0.5 + (SIZE + 1) / (2 * LEAST)
RARE = 1e-6
#: Parts of a group that meet its estimates apart, so that one with most rows is not one task's work.
PARTS = 32


def chi_square_tail(x: float, degrees: int) -> float:
    """Share of the chi-square distribution above x, for an even number of degrees."""
    return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(degrees // 2))


def chi_square_quantile(tail: float, degrees: int) -> float:
    low, high = 0.0, 200.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_tail(middle, degrees) > tail else (low, middle)
    return low


CUTOFF = chi_square_quantile(RARE, SIZE)
#: The nearest share H of normal data spreads less than all of it.
WIDEN = H / (1 - chi_square_tail(chi_square_quantile(1 - H, SIZE), SIZE + 2))


def vector() -> Column:
    """Mean word length, symbols, repeated lines and repeated words, the latter per 100 words, all as logarithms."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return F.array(F.log((F.col("word_chars") + 1) / (n + 1)),
                   *[F.log1p(100 * F.col(c) / n) for c in ("n_symbols", "n_dup_lines", "n_repeat_words")])


def _at(column: str, i: int) -> Column:
    return F.col(column)[i]


def distance() -> Column:
    """Squared Mahalanobis distance of `x` from `centre` by the inverse covariance `inverse`, row by row flattened."""
    away = [_at("x", i) - _at("centre", i) for i in range(SIZE)]
    return sum(_at("inverse", i * SIZE + j) * away[i] * away[j] for i in range(SIZE) for j in range(SIZE))


def _invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Centre, inverse of the covariance with the floors added, and log determinant, from n, sums and sums of products."""
    floor = np.diag(np.square(FLOORS))
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            n = max(1, r["n"])
            mean = np.array(r["sums"]) / n
            spread = np.array(r["products"]).reshape(SIZE, SIZE) / n - np.outer(mean, mean)
            whole = WIDEN * spread + floor
            r["centre"], r["inverse"] = mean.tolist(), np.linalg.inv(whole).ravel().tolist()
            r["log_det"] = float(np.linalg.slogdet(whole)[1])
        names = ["group", "start", "centre", "inverse", "log_det"]
        kinds = [pa.string(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)


def _moments(rows: DataFrame) -> DataFrame:
    sums = F.array(*[F.sum(_at("x", i)) for i in range(SIZE)])
    products = F.array(*[F.sum(_at("x", i) * _at("x", j)) for i in range(SIZE) for j in range(SIZE)])
    made = rows.groupBy("group", "start").agg(F.count("*").alias("n"), sums.alias("sums"), products.alias("products"))
    return made.mapInArrow(_invert, "group string, start int, centre array<double>, inverse array<double>, log_det double")


def _parted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)))


def _meet(rows: DataFrame, of_group: DataFrame) -> DataFrame:
    """Rows of _parted with what is known of their group."""
    return rows.join(of_group.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long")))), ["group", "part"])


def _starts(rows: DataFrame) -> DataFrame:
    """Per group: medians with diagonal spreads by median deviations (0), means with covariances (1)."""
    middles = rows.groupBy("group").agg(*[F.percentile_approx(_at("x", i), 0.5, 1000).alias(f"m{i}") for i in range(SIZE)])
    off = _meet(rows, middles).select("group", *[F.col(f"m{i}") for i in range(SIZE)], *[
        F.abs(_at("x", i) - F.col(f"m{i}")).alias(f"a{i}") for i in range(SIZE)])
    spreads = off.groupBy("group", *[f"m{i}" for i in range(SIZE)]).agg(
        *[(1.4826 * F.percentile_approx(f"a{i}", 0.5, 1000)).alias(f"s{i}") for i in range(SIZE)])
    zero = F.lit(0.0)
    robust = spreads.select(
        "group", F.lit(0).alias("start"), F.array(*[f"m{i}" for i in range(SIZE)]).alias("centre"),
        F.array(*[1 / (F.col(f"s{i}") * F.col(f"s{i}") + FLOORS[i] ** 2) if i == j else zero
                  for i in range(SIZE) for j in range(SIZE)]).alias("inverse"), F.lit(float("inf")).alias("log_det"))
    return robust.unionByName(_moments(rows.withColumn("start", F.lit(1))))


def estimates(rows: DataFrame) -> DataFrame:
    """rows (group, x) to (group, centre, inverse): the concentration steps end when no determinant moves, or after STEPS."""
    rows = _parted(rows)
    now = saved(_starts(rows), "estimates")
    for _ in range(STEPS):
        limit = _meet(rows, now).groupBy("group", "start").agg(F.percentile_approx(distance(), H, 1000).alias("limit"))
        near = _meet(rows, now.join(limit, ["group", "start"])).filter(distance() <= F.col("limit"))
        after = saved(_moments(near), "estimates")
        moved = after.select("group", "start", F.col("log_det").alias("new")).join(
            now, ["group", "start"]).filter(F.abs(F.col("new") - F.col("log_det")) > STILL)
        now = after
        if moved.isEmpty():
            break
    return now.groupBy("group").agg(F.min_by(F.struct("centre", "inverse"), F.struct("log_det", "start")).alias("e")).select(
        "group", "e.centre", "e.inverse")


def _grouped(rows: DataFrame) -> DataFrame:
    """Rows with the group they are judged in."""
    by_source = rows.groupBy("group_0", "group_1").agg(F.count("*").alias("n"))
    few = F.sum(F.when(F.col("n") < LEAST, F.col("n")).otherwise(0))
    by_lang = by_source.groupBy("group_0").agg(few.alias("few"))
    own = by_source.join(by_lang.withColumnRenamed("group_0", "lang"), F.col("group_0").eqNullSafe(F.col("lang")))
    name = (F.when(F.col("n") >= LEAST, F.to_json(F.array("group_0", "group_1")))
            .when(F.col("few") >= LEAST, F.to_json(F.array("group_0"))).otherwise(F.lit("[]")))
    named = own.select(F.col("group_0").alias("lang"), F.col("group_1").alias("source"), name.alias("group"))
    return rows.join(named, F.col("group_0").eqNullSafe(F.col("lang")) & F.col("group_1").eqNullSafe(F.col("source"))).drop("lang", "source")


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           source_col: str = "source") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance of every row.

    base_failed: under 50 words, or over half of the words in repeated three-word windows. kept: neither that nor an
    outlier of its group. Null texts count as empty and fail; null languages and sources are groups like any other;
    a group whose rows are all alike keeps them all. Repeated rows are judged each; other columns are ignored.
    """
    rows = counted(docs, id_col, text_col, (lang_col, source_col)).withColumn(
        "base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
    rows = saved(_grouped(saved(rows, "counts")).withColumn("x", vector()).drop("group_0", "group_1"), "vectors")
    found = estimates(rows.filter(~F.col("base_failed")).select("group", "x"))
    scored = rows.join(found, "group", "left").withColumn("distance", distance())
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF)
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         kept.alias("kept"), "distance")
