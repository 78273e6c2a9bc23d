"""Registered queries: aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsdesk.functions import ids
from newsdesk.operators import categories, counts, feeds, pubs, work
from newsdesk.plans.common import QUEUE_THRESHOLD, _COUNTS_SQL, _DUP_SQL
from newsdesk.plans.registry import NOW, query, ts_str
from newsdesk.sources import driver_tables as dt


@query("article_counts", _COUNTS_SQL)
def q_article_counts(spark, d):
    return counts.article_counts(dt.articles(spark, d))


@query("article_counts_incremental", _COUNTS_SQL)
def q_article_counts_incremental(spark, d):
    a = dt.articles(spark, d)
    cut = ids.id_from_number(F.lit(5000))
    first = counts.article_counts(a.filter(F.col("article_id") <= cut))
    # the cursor after the first run is the cut; the second run reads up to
    # the current watermark (the largest id)
    upto = None
    return counts.article_counts_incremental(first, a, "%024x" % 5000, upto)


@query("article_id_watermark", """
SELECT count(*) AS n, max(article_id) AS last_id FROM d_article""")
def q_article_id_watermark(spark, d):
    return counts.article_id_watermark(dt.articles(spark, d))


@query("last_article", """SELECT max(article_id) AS last_id FROM d_article""")
def q_last_article(spark, d):
    return counts.last_article(dt.articles(spark, d))


@query("apply_counts", f"""
, c AS ({_COUNTS_SQL})
SELECT p.pub_id, CAST(coalesce(c.n, 0) AS INTEGER) AS num_articles
FROM d_pub p LEFT JOIN c ON c.type = 'pub' AND c.id = p.pub_id""")
def q_apply_counts(spark, d):
    c = counts.article_counts(dt.articles(spark, d))
    return counts.apply_counts(dt.pubs(spark, d), c, "pub", "pub_id").select("pub_id", "num_articles")


@query("unique_categories", f"""
SELECT replace(lower(c), ' ', '_') AS category_id, min(c) AS category, '{NOW}' AS added
FROM (SELECT unnest(categories) AS c FROM d_pub) GROUP BY 1""")
def q_unique_categories(spark, d):
    out = categories.unique_categories(dt.pubs(spark, d), None, NOW)
    return out.select("category_id", "category", ts_str("added").alias("added"))


@query("duplicate_pubs", f"""
, {_DUP_SQL}
SELECT old_id, new_id, name FROM d_dups""")
def q_duplicate_pubs(spark, d):
    return pubs.duplicate_pubs(dt.pubs(spark, d))


@query("merge_publications", f"""
, {_DUP_SQL}
SELECT a.article_id, coalesce(m.new_id, a.pub_id) AS pub_id FROM d_article a LEFT JOIN d_dups m ON a.pub_id = m.old_id""")
def q_merge_publications(spark, d):
    _p, _f, a = pubs.merge_publications(dt.pubs(spark, d), dt.feeds(spark, d), dt.articles(spark, d))
    return a.select("article_id", "pub_id")


@query("queue_depth", f"""
SELECT stage, count(*) AS depth,
  CASE WHEN count(*) > {QUEUE_THRESHOLD}
       THEN 'stage ' || stage || ': ' || CAST(count(*) AS VARCHAR) || ' rows wait, at most {QUEUE_THRESHOLD} may' END AS error
FROM d_work GROUP BY stage""")
def q_queue_depth(spark, d):
    return work.queue_depth(dt.work(spark, d), QUEUE_THRESHOLD)


@query("topic_depth", f"""
, m AS (SELECT event_type || '-' || CAST(user_id % 2 AS VARCHAR) AS topic,
          CASE WHEN event_type = 'error' OR (event_type = 'view' AND user_id % 50 = 0) THEN NULL ELSE event_type || CAST(user_id % 3 AS VARCHAR) END AS channel
        FROM events),
t AS (SELECT topic, count(DISTINCT channel) AS channels, count_if(channel IS NULL) AS undelivered, count(channel) AS depth FROM m GROUP BY topic)
SELECT topic, channels, CAST(undelivered AS BIGINT) AS undelivered, depth,
  CASE WHEN channels = 0 THEN 'topic ' || topic || ': no channel reads it'
       WHEN undelivered > 0 THEN 'topic ' || topic || ': ' || CAST(undelivered AS VARCHAR) || ' messages are not in a channel'
       WHEN depth > {QUEUE_THRESHOLD // 2} THEN 'topic ' || topic || ': ' || CAST(depth AS VARCHAR) || ' messages wait, at most {QUEUE_THRESHOLD // 2} may' END AS error
FROM t""")
def q_topic_depth(spark, d):
    """The events as messages of ten topics; errors are in no channel, and some
    views are in none yet."""
    e, u = F.col("event_type"), F.col("user_id")
    m = dt.read(spark, d, "events").select(
        F.concat(e, F.lit("-"), (u % 2).cast("string")).alias("topic"),
        F.when((e == "error") | ((e == "view") & (u % 50 == 0)), F.lit(None)).otherwise(F.concat(e, (u % 3).cast("string"))).alias("channel"))
    return work.topic_depth(m, QUEUE_THRESHOLD // 2)


@query("pub_feed_count", """
SELECT pub_id, CAST(count(*) AS INTEGER) AS num_feeds FROM d_feed WHERE NOT deleted GROUP BY pub_id""")
def q_pub_feed_count(spark, d):
    return pubs.pub_feed_count(dt.feeds(spark, d))
