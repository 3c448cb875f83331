"""Verdicts on page URLs."""

from __future__ import annotations

from mercato.llm.catalog import query
from mercato.llm.store import table
from mercato.llm.url_filter import ALLOW, BLOCK, judge_urls

# The entries to apply.
ENTRIES = [("org/", ALLOW), ("example.org/es/", BLOCK), ("example.org/en/1", BLOCK), ("com/fr/", ALLOW), ("com/de/", BLOCK)]

URL_SQL = r"""
WITH rules(rule, host, path, verdict) AS (VALUES
  ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
  ('com/de/', 'com', '/de/', 'block')),
urls AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages)
SELECT u.page_id, u.host, u.path,
       (SELECT arg_max(r.rule, length(r.host) * 100000 + length(r.path)) FROM rules r
        WHERE (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)) AS rule,
       coalesce((SELECT arg_max(r.verdict, length(r.host) * 100000 + length(r.path)) FROM rules r
        WHERE (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)), 'allow') AS verdict
FROM urls u
"""


@query("op1_url_filter", URL_SQL)
def url_filter(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"), ENTRIES)
