"""Registered queries: the flagship query."""

from __future__ import annotations


from newsdesk.plans.common import _CLEAN_URL_SQL
from newsdesk.plans.registry import ORACLE, query


@query("rss_article_counts", """
, base AS (SELECT page_id, link, page_id % 1000000 AS b FROM d_links),
""" + "__CLEAN__" + """,
kept AS (SELECT c.page_id, b.b FROM d_clean c JOIN base b ON c.page_id = b.page_id
         QUALIFY row_number() OVER (PARTITION BY c.clean ORDER BY printf('%024x', c.page_id)) = 1)
SELECT type, id, count(*) AS n FROM (
  SELECT 'pub' AS type, printf('%024x', b % 150) AS id FROM kept
  UNION ALL SELECT 'feed', printf('%024x', b % 15) FROM kept)
GROUP BY type, id""")
def q_rss_article_counts(spark, d):
    from newsdesk.plans.flagship import rss_article_counts
    return rss_article_counts(spark, d)


ORACLE["rss_article_counts"] = ORACLE["rss_article_counts"].replace("__CLEAN__", _CLEAN_URL_SQL.strip())
