"""Registered queries: scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsdesk.functions import dates, ids, text, urls
from newsdesk.operators import articles as art
from newsdesk.operators import categories, feeds, pubs, work
from newsdesk.plans.common import _CLEAN_URL_SQL, _ENTRY_ROWS_SQL, _loose_strings, _new_entries
from newsdesk.plans.registry import query, ts_sql, ts_str
from newsdesk.sources import driver_tables as dt


@query("clean_url", f"""
, {_CLEAN_URL_SQL}
SELECT page_id, link, clean FROM d_clean""")
def q_clean_url(spark, d):
    return dt.entry_links(spark, d).select("page_id", "link", urls.clean_url("link").alias("clean"))


@query("entry_dedupe", f"""
, {_CLEAN_URL_SQL},
firsts AS (SELECT clean, page_id, row_number() OVER (PARTITION BY clean ORDER BY page_id) AS rn FROM d_clean)
SELECT clean AS link, page_id FROM firsts WHERE rn = 1""")
def q_entry_dedupe(spark, d):
    e = dt.entry_links(spark, d).select("page_id", urls.clean_url("link").alias("link"))
    return feeds.entry_dedupe(e, None, order=("page_id",)).select("link", "page_id")


@query("entry_dedupe_seen", """
, firsts AS (SELECT link, event_id, entry_pos,
  row_number() OVER (PARTITION BY link ORDER BY fetched_at, feed_id, entry_pos) AS rn
  FROM d_entry WHERE coalesce(status, 500) NOT IN (304, 410, 500) AND link IS NOT NULL)
SELECT link, event_id, entry_pos FROM firsts WHERE rn = 1 AND link NOT IN (SELECT link FROM d_work)""")
def q_entry_dedupe_seen(spark, d):
    e = feeds.feed_entries(dt.feed_polls(spark, d)).select(
        "link", "event_id", "entry_pos", "fetched_at", "feed_id")     # the order columns and the output
    return feeds.entry_dedupe(e, dt.work(spark, d)).select("link", "event_id", "entry_pos")


@query("resolve_url", """
SELECT article_id, CASE WHEN location IS NOT NULL
  THEN regexp_extract(link, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || location ELSE link END AS url
FROM d_page""")
def q_resolve_url(spark, d):
    p = dt.page_fetches(spark, d)
    return p.select("article_id", urls.resolve_url(F.col("location"), F.col("link")).alias("url"))


@query("parse_rfc1123", f"""
SELECT article_id, {ts_sql('''CASE WHEN page_id % 4 = 1 THEN fetched_at + INTERVAL 7 HOUR
  WHEN page_id % 4 = 2 THEN NULL ELSE fetched_at END''')} AS published FROM d_page""")
def q_parse_rfc1123(spark, d):
    p = dt.page_fetches(spark, d)
    return p.select("article_id", ts_str(dates.parse_rfc1123("published")).alias("published"))


@query("parse_loose_date", f"""
SELECT event_id, {ts_sql('''CASE event_id % 6 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts)
  WHEN 2 THEN date_trunc('day', ts) WHEN 3 THEN date_trunc('day', ts) WHEN 4 THEN date_trunc('second', ts) END''')} AS parsed
FROM events""")
def q_parse_loose_date(spark, d):
    return _loose_strings(spark, d).select("event_id", ts_str(dates.parse_loose_date("s")).alias("parsed"))


@query("published_fallback", f"""
SELECT article_id, {ts_sql("coalesce(published, TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST(('0x' || substr(article_id, 1, 8)) AS BIGINT)))")} AS published
FROM d_article""")
def q_published_fallback(spark, d):
    return art.published_fallback(dt.articles(spark, d)).select(
        "article_id", ts_str("published").alias("published"))


@query("objectid_time", f"""
SELECT event_id, {ts_sql("date_trunc('second', ts)")} AS t FROM events""")
def q_objectid_time(spark, d):
    ev = dt.read(spark, d, "events")
    return ev.select("event_id", ts_str(ids.objectid_time(ids.make_id(F.col("ts"), F.col("event_id")))).alias("t"))


@query("make_id", f"""
, {_ENTRY_ROWS_SQL}
SELECT event_id, entry_pos, article_id FROM d_entry_rows""")
def q_make_id(spark, d):
    return _new_entries(spark, d).select("event_id", "entry_pos", "article_id")


@query("category_slug", """
SELECT DISTINCT c AS category, replace(lower(c), ' ', '_') AS slug, replace(c, ' ', '') AS key
FROM (SELECT unnest(categories) AS c FROM d_pub)""")
def q_category_slug(spark, d):
    c = dt.pubs(spark, d).select(F.explode("categories").alias("category")).distinct()
    return c.select("category", text.category_slug("category").alias("slug"),
                    text.category_key("category").alias("key"))


@query("next_download", f"""
SELECT event_id, {ts_sql("CASE WHEN bozo = 0 THEN fetched_at + INTERVAL 1 HOUR END")} AS next_download FROM d_poll""")
def q_next_download(spark, d):
    p = dt.feed_polls(spark, d)
    return p.select("event_id", ts_str(feeds.next_download("bozo", F.col("fetched_at"))).alias("next_download"))


@query("moved_url", """
SELECT p.event_id, CASE WHEN p.status = 301 THEN p.href ELSE f.url END AS url,
  CASE WHEN p.status = 301 THEN f.url END AS original_url
FROM d_poll p JOIN d_feed f ON p.feed_id = f.feed_id""")
def q_moved_url(spark, d):
    p = dt.feed_polls(spark, d).select("event_id", "feed_id", "status", "href")
    f = dt.feeds(spark, d).select("feed_id", "url")
    j = p.join(f, "feed_id")
    url, original = feeds.moved_url(F.col("status"), F.col("href"), F.col("url"))
    return j.select("event_id", url.alias("url"), original.alias("original_url"))


@query("pubs_by_name", """
SELECT pub_id, name FROM d_pub ORDER BY name, pub_id""")
def q_pubs_by_name(spark, d):
    return pubs.pubs_by_name(dt.pubs(spark, d)).select("pub_id", "name")
