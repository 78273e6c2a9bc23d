"""Registered queries: sources and the legacy dump."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsdesk.functions import text
from newsdesk.operators import categories, feeds, pubs, tables
from newsdesk.plans.common import _ID_REQ_SQL, _id_requests, _job_store, _legacy_dump, _run_dir, _wire
from newsdesk.plans.registry import joined, query, ts_sql, ts_str
from newsdesk.sources import driver_tables as dt


@query("read_catalog", """
SELECT pub_id, name, homepage, country, num_readers,
       array_to_string(categories, '|') AS categories, deleted
FROM d_pub""")
def q_read_catalog(spark, d):
    """A catalogue table written as a version of the table store and scanned."""
    from newsdesk import schema as S
    return _job_store(spark, d).read("pubs", S.PUB).select(
        "pub_id", "name", "homepage", "country", "num_readers", joined("categories").alias("categories"), "deleted")


@query("read_by_ids", f"""
, {_ID_REQ_SQL}
SELECT feed_id, url FROM d_feed
WHERE feed_id IN (SELECT lower(id) FROM d_req WHERE regexp_full_match(id, '[0-9a-fA-F]{{24}}'))""")
def q_read_by_ids(spark, d):
    found, _bad = tables.read_by_ids(dt.feeds(spark, d), _id_requests(spark, d), "feed_id")
    return found.select("feed_id", "url")


@query("read_wire", """
SELECT seq, wid AS id, title, published_date, wire_feed_id AS feed_id, country,
       segment || '|News' AS topics
FROM d_wire""")
def q_read_wire(spark, d):
    return _wire(spark, d, mapped=False).select(
        "seq", F.col("a.id").alias("id"), F.col("a.title").alias("title"),
        F.col("a.publishedDate").alias("published_date"),
        F.col("a.source.feed.id").alias("feed_id"),
        F.col("a.source.location.country").alias("country"),
        joined(F.col("a.source.feed.editorialTopics.editorialTopic")).alias("topics"))


@query("read_page_fetches", """
SELECT article_id, link, content_type, CAST(n_bytes AS INTEGER) AS n_bytes FROM d_page""")
def q_read_page_fetches(spark, d):
    from newsdesk.sources.files import read_page_fetches
    path = _run_dir(spark, "page_fetches")
    dt.page_fetches(spark, d).write.parquet(path)
    return read_page_fetches(spark, path).select("article_id", "link", "content_type", F.octet_length("html").alias("n_bytes"))


@query("read_feed_fetches", f"""
SELECT feed_id, {ts_sql('fetched_at')} AS fetched_at, CAST(status AS VARCHAR) AS status, bozo, etag,
  3::INTEGER AS n_entries,
  'http://news.example.com/' || CAST(event_id % 5000 AS VARCHAR) || '/story?utm_source=rss&id=' || CAST(event_id % 7 AS VARCHAR) AS second_link
FROM d_poll""")
def q_read_feed_fetches(spark, d):
    # status is NULL when the poll reported none: carried as text so a NULL
    # stays NULL through any conversion of the result (no NaN)
    from newsdesk.sources.files import read_feed_fetches
    path = _run_dir(spark, "feed_fetches")
    dt.feed_polls(spark, d).drop("event_id").write.json(path)        # as they are landed: JSON lines
    return read_feed_fetches(spark, path).select(
        "feed_id", ts_str("fetched_at").alias("fetched_at"), F.col("status").cast("string").alias("status"), "bozo", "etag",
        F.size("entries").alias("n_entries"), F.element_at("entries", 2)["link"].alias("second_link"))


@query("read_legacy_pubs", """
SELECT lower(lpad(hex(1262304000 + c_custkey), 8, '0') || printf('%016x', c_custkey)) AS pub_id,
  c_name AS name, CAST(c_custkey % 4 AS INTEGER) AS num_feeds,
  CASE WHEN c_custkey % 3 = 0 THEN '//h1' END AS xpath_title,
  strftime(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(1262304000 + c_custkey), '%Y-%m-%d %H:%M:%S') AS added
FROM customer""")
def q_read_legacy_pubs(spark, d):
    from newsdesk.sources.files import read_legacy_pubs
    p, _f = read_legacy_pubs(spark, _legacy_dump(spark, d))
    return p.select("pub_id", "name", "num_feeds", joined("xpath_title").alias("xpath_title"),
                    ts_str("added").alias("added"))


@query("legacy_pub_feeds", """
SELECT lower(lpad(hex(1262304000 + c_custkey), 8, '0') || printf('%016x', c_custkey * 4 + i)) AS feed_id,
  lower(lpad(hex(1262304000 + c_custkey), 8, '0') || printf('%016x', c_custkey)) AS pub_id,
  'http://legacy.example.com/' || CAST(c_custkey AS VARCHAR) || '/' || CAST(i AS VARCHAR) || '.xml' AS url
FROM customer, range(CAST(c_custkey % 4 AS BIGINT)) t(i)""")
def q_legacy_pub_feeds(spark, d):
    from newsdesk.sources.files import read_legacy_pubs
    _p, f = read_legacy_pubs(spark, _legacy_dump(spark, d))
    return f.select("feed_id", "pub_id", "url")
