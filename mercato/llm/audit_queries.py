"""Interaction of filters."""

from __future__ import annotations

from mercato.llm.catalog import query
from mercato.llm.filter_audit import audit
from mercato.llm.store import table

AUDIT_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_id FROM texts GROUP BY t),
marks AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
          FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
         regexp_matches(t, '[#$%&*|]'), coalesce(x.doc_id > first_id, false)] AS f,
         coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM texts x JOIN firsts USING (t) LEFT JOIN marks m ON m.doc_id = x.doc_id),
letters AS (SELECT unnest(range(1, 6)) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (SELECT o, list_aggregate(list_transform(o, lambda k: substr('ABCDE', k, 1)), 'string_agg', '') AS filter_order,
          unnest(range(1, 6)) AS step FROM orders),
sets AS (SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
         FROM judged GROUP BY part, f),
applied AS (
  SELECT part, filter_order, step, o[step] AS own, n, good, toxic, f[o[step]] AS fails,
         len(list_filter(o[1:step - 1], lambda k: f[k])) > 0 AS earlier, len(list_filter(f, lambda y: y)) AS failed
  FROM sets, steps),
added AS (
  SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (WHERE NOT fails AND NOT earlier), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE fails AND NOT earlier), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE fails AND earlier), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE fails AND failed = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE fails AND NOT earlier), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE fails AND NOT earlier), 0) AS toxic_lost
  FROM applied GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM added
"""


@query("op11_filter_audit", AUDIT_SQL)
def filter_audit(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
