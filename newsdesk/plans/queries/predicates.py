"""Registered queries: projections, filters, predicates."""

from __future__ import annotations


from pyspark.sql import functions as F

from newsdesk.functions import ids, text
from newsdesk.operators import articles as art
from newsdesk.operators import categories, feeds, pubs
from newsdesk.plans.common import SMALL_PAGE_LIMIT, _REASON_SQL, _ROUTE_SQL
from newsdesk.plans.fixture_sql import NOW as SQL_NOW
from newsdesk.plans.registry import NOW, joined, query, ts_sql, ts_str
from newsdesk.sources import driver_tables as dt


@query("feeds_due", f"""
SELECT feed_id, {ts_sql('next_download')} AS next_download FROM d_feed
WHERE coalesce(bozo, 0) = 0 AND metabase_id IS NULL AND (next_download IS NULL OR next_download <= {SQL_NOW})
ORDER BY next_download ASC NULLS FIRST, feed_id LIMIT 25""")
def q_feeds_due(spark, d):
    return feeds.feeds_due(dt.feeds(spark, d), NOW, 25).select(
        "feed_id", ts_str("next_download").alias("next_download"))


@query("feeds_not_due", f"""
SELECT feed_id FROM d_feed WHERE metabase_id IS NULL AND (next_download IS NULL OR next_download >= {SQL_NOW} - INTERVAL 2 DAY)""")
def q_feeds_not_due(spark, d):
    now = "2024-01-28 12:00:00"
    return feeds.feeds_not_due(dt.feeds(spark, d), now).select("feed_id")


@query("entries_with_link", """
SELECT event_id, entry_pos, link FROM d_entry
WHERE coalesce(status, 500) NOT IN (304, 410, 500) AND link IS NOT NULL""")
def q_entries_with_link(spark, d):
    return feeds.entries_with_link(feeds.feed_entries(dt.feed_polls(spark, d))).select(
        "event_id", "entry_pos", "link")


@query("feed_entries", """
SELECT event_id, entry_pos, link, author FROM d_entry WHERE coalesce(status, 500) NOT IN (304, 410, 500)""")
def q_feed_entries(spark, d):
    return feeds.feed_entries(dt.feed_polls(spark, d)).select("event_id", "entry_pos", "link", "author")


@query("fetch_status_filter", """
SELECT event_id, status FROM d_poll WHERE coalesce(status, 500) NOT IN (304, 410, 500)""")
def q_fetch_status_filter(spark, d):
    return feeds.fetch_status_filter(dt.feed_polls(spark, d)).select("event_id", "status")


@query("page_validate", f"""
SELECT article_id, {_REASON_SQL} AS reject_reason FROM d_page""")
def q_page_validate(spark, d):
    return art.page_validate(dt.page_fetches(spark, d), SMALL_PAGE_LIMIT).select("article_id", "reject_reason")


@query("has_html", """
SELECT article_id, CASE WHEN n_bytes = 0 THEN 'No HTML' END AS reject_reason FROM d_page""")
def q_has_html(spark, d):
    return art.has_html(dt.page_fetches(spark, d)).select("article_id", "reject_reason")


@query("extract_route", _ROUTE_SQL)
def q_extract_route(spark, d):
    j = art.extract_route(art.article_pub_rules(dt.page_fetches(spark, d), dt.pubs(spark, d)))
    return j.select("article_id", "pub_id", "route", "reject_reason")


@query("article_pub_rules", """
SELECT g.article_id, array_to_string(p.xpath_title, '|') AS xpath_title,
  array_to_string(p.xpath_body, '|') AS xpath_body,
  CASE WHEN p.pub_id IS NULL THEN 'No pub found' END AS reject_reason
FROM d_page g LEFT JOIN d_pub p ON g.pub_id = p.pub_id""")
def q_article_pub_rules(spark, d):
    j = art.article_pub_rules(dt.page_fetches(spark, d), dt.pubs(spark, d))
    return j.select("article_id", joined("xpath_title").alias("xpath_title"),
                    joined("xpath_body").alias("xpath_body"), "reject_reason")


@query("origin_tag", """
SELECT article_id, origin, is_lexisnexis FROM d_article""")
def q_origin_tag(spark, d):
    st = F.col("o_orderstatus")
    o = dt.read(spark, d, "orders").select("o_orderkey", st.isin("F", "O").alias("wire"), (st == "O").alias("is_lexisnexis"))
    return o.select(ids.id_from_number(F.col("o_orderkey")).alias("article_id"),
                    art.origin_tag(F.col("wire"), F.col("is_lexisnexis")).alias("origin"), "is_lexisnexis")


@query("empty_body_flag", """
SELECT article_id, coalesce(octet_length(encode(body_text)), 0) < 1 AS rss_empty,
       coalesce(octet_length(encode(body_text)), 0) < 10 AS wire_empty FROM d_text""")
def q_empty_body_flag(spark, d):
    t = dt.text_articles(spark, d)
    return t.select("article_id", text.empty_body_flag("body_text", 1).alias("rss_empty"),
                    text.empty_body_flag("body_text", 10).alias("wire_empty"))


@query("pubs_missing_categories", """
SELECT pub_id FROM d_pub WHERE coalesce(len(categories), 0) = 0""")
def q_pubs_missing_categories(spark, d):
    return pubs.pubs_missing_categories(dt.pubs(spark, d)).select("pub_id")


@query("pubs_with_categories", """
SELECT pub_id FROM d_pub WHERE coalesce(len(categories), 0) > 0""")
def q_pubs_with_categories(spark, d):
    return pubs.pubs_with_categories(dt.pubs(spark, d)).select("pub_id")


@query("wire_origin_filter", """
SELECT article_id, origin FROM d_article WHERE origin IN ('webnews', 'lexisnexis')""")
def q_wire_origin_filter(spark, d):
    return pubs.wire_origin_filter(dt.articles(spark, d)).select("article_id", "origin")
