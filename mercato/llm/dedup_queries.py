"""Near-duplicate documents."""

from __future__ import annotations

from mercato.llm.catalog import query
from mercato.llm.minhash_forest import near_duplicates
from mercato.llm.store import table

NEAR_SQL = """
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
         lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM texts WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * k >= 75 * (p.n + q.n - k)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM texts
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT t.doc_id, coalesce(n, 0) AS n_shingles, c.component_id, t.doc_id = c.component_id AS kept
FROM texts t LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""


@query("op10_near_duplicates", NEAR_SQL)
def near_duplicate_classes(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
