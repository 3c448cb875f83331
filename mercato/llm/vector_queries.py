"""Nearest neighbours and clusters of embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.llm.catalog import query
from mercato.llm.one_bit_codes import search
from mercato.llm.pca_clusters import clusters
from mercato.llm.store import table

NEAREST = 10
SIZE, CLUSTERS, ROUNDS = 64, 16, 3

SEARCH_SQL = """
WITH given AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[2] - p[1]) * (p[2] - p[1])))) AS score
  FROM given q JOIN given c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM pairs) WHERE rank <= 10
"""


def _near(number: int) -> str:
    """Vectors with their nearest centroid of round `number`."""
    return f"""near{number} AS MATERIALIZED (
  SELECT row, vec_id, x, arg_min(c, (d, c)) AS cluster, min(d) AS distance FROM (
    SELECT k.row, k.vec_id, k.x, m.c, list_sum(list_transform(list_zip(k.x, m.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM kept k, centre{number} m) GROUP BY row, vec_id, x)"""


def _moved(number: int) -> str:
    """Centroids of round `number`, from the vectors of the round before."""
    return f"""centre{number} AS MATERIALIZED (
  SELECT o.c, coalesce(m.x, o.x) AS x FROM centre{number - 1} o LEFT JOIN (
    SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS x FROM (
      SELECT cluster, j, sum(x[j]) AS s, count(*) AS n FROM near{number - 1}, (SELECT unnest(range(1, {SIZE + 1})) AS j) GROUP BY cluster, j)
    GROUP BY cluster) m ON m.cluster = o.c)"""


CLUSTER_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda v: floor(64 * v::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
centre0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM (SELECT x, sha256('1:' || vec_id) AS h FROM kept) ORDER BY h, x LIMIT {CLUSTERS}),
{", ".join(f"{_near(i)}, {_moved(i + 1)}" for i in range(ROUNDS))},
{_near(ROUNDS)}
SELECT vec_id, cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(m.x, ',')) AS centroid_sha256
FROM near{ROUNDS} n JOIN centre{ROUNDS} m ON m.c = n.cluster
"""


@query("op12_one_bit_search", SEARCH_SQL)
def one_bit_search(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, NEAREST)


def centroid_digests(rows):
    made = clusters(rows, SIZE, CLUSTERS, ROUNDS, F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256))
    text = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return made.withColumn("centroid_sha256", F.sha2(text.cast("binary"), 256)).drop("centroid")


@query("op13_pca_clusters", CLUSTER_SQL)
def pca_clusters(spark, sf_dir):
    return centroid_digests(table(spark, sf_dir, "embeddings"))
