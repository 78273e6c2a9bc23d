"""Registered queries: joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsdesk.operators import articles as art
from newsdesk.operators import categories, feeds, pubs
from newsdesk.plans.common import _DUP_SQL, _alias_sql, _wire_articles
from newsdesk.plans.registry import ORACLE, joined, query
from newsdesk.sources import driver_tables as dt
from newsdesk.sources.wire import parse_wire


@query("new_articles", """
, store AS (SELECT * FROM d_article WHERE o_orderkey % 2 = 0),
batch AS (SELECT * FROM d_article WHERE o_orderkey % 2 = 1),
judged AS (
  SELECT b.article_id, b.url,
    CASE WHEN EXISTS (SELECT 1 FROM store s WHERE s.url = b.url AND s.article_id <> b.article_id)
           OR (NOT EXISTS (SELECT 1 FROM store s WHERE s.url = b.url)
               AND EXISTS (SELECT 1 FROM batch c WHERE c.url = b.url AND c.article_id < b.article_id))
         THEN 'Article URL already exists' END AS reject_reason
  FROM batch b)
SELECT * FROM judged""")
def q_new_articles(spark, d):
    a = dt.articles(spark, d)
    k = F.conv(F.col("article_id"), 16, 10).cast("bigint")
    judged = art.judge_new_articles(a.filter(k % 2 == 1), a.filter(k % 2 == 0))
    return judged.select("article_id", "url", "reject_reason")


@query("pub_repoint", f"""
, {_DUP_SQL}
SELECT f.feed_id, coalesce(m.new_id, f.pub_id) AS pub_id FROM d_feed f LEFT JOIN d_dups m ON f.pub_id = m.old_id""")
def q_pub_repoint(spark, d):
    m = pubs.duplicate_pubs(dt.pubs(spark, d))
    return pubs.pub_repoint(dt.feeds(spark, d), m).select("feed_id", "pub_id")


@query("category_alias_lookup", None)
def q_category_alias_lookup(spark, d):
    return categories.category_alias_lookup(dt.pubs(spark, d), categories.alias_table(spark))


ORACLE["category_alias_lookup"] = _alias_sql()


@query("pub_category_backfill", """
, need AS (SELECT pub_id FROM d_pub WHERE coalesce(len(categories), 0) = 0),
latest AS (SELECT pub_id, max(o_orderkey) AS k FROM d_article
           WHERE origin IN ('webnews', 'lexisnexis') AND pub_id IN (SELECT pub_id FROM need) GROUP BY pub_id)
SELECT p.pub_id, CASE WHEN l.k IS NULL THEN array_to_string(p.categories, '|') ELSE w.segment || '|News' END AS categories,
  CASE WHEN l.k IS NULL THEN p.country ELSE w.country END AS country,
  CASE WHEN l.k IS NULL THEN p.genre ELSE w.genre END AS genre
FROM d_pub p LEFT JOIN latest l ON p.pub_id = l.pub_id LEFT JOIN d_wire w ON w.seq = l.k""")
def q_pub_category_backfill(spark, d):
    out = pubs.pub_category_backfill(dt.pubs(spark, d), _wire_articles(spark, d),
                                     lambda c: parse_wire(spark, F.decode(c, "UTF-8"), mapped=True))
    return out.select("pub_id", joined("categories").alias("categories"), "country", "genre")


@query("latest_article_per_pub", """
SELECT pub_id, max(article_id) AS article_id FROM d_article WHERE origin IN ('webnews', 'lexisnexis') GROUP BY pub_id""")
def q_latest_article_per_pub(spark, d):
    a = dt.articles(spark, d).select("pub_id", "article_id", "origin")   # only what the struct needs
    return pubs.latest_article_per_pub(a).select("pub_id", "article_id")
