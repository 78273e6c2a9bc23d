"""Registered queries: sinks and table updates."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsdesk.functions import dates
from newsdesk.operators import articles as art
from newsdesk.operators import feeds, pubs, tables, work
from newsdesk.plans.common import (
    SMALL_PAGE_LIMIT, _DUP_SQL, _ENTRY_ROWS_SQL, _LATEST_POLL_SQL, _REASON_SQL, _new_entries,
    _run_dir, _store_and_new)
from newsdesk.plans.fixture_sql import NOW as SQL_NOW
from newsdesk.plans.registry import NOW, query, ts_sql, ts_str
from newsdesk.sources import driver_tables as dt


@query("upsert_articles", """
SELECT article_id, CASE WHEN o_orderkey % 3 = 0 THEN title || ' (v2)' ELSE title END AS title, url FROM d_article
UNION ALL
SELECT printf('%024x', o_orderkey + 1000000000), title || ' (new)', url FROM d_article WHERE o_orderkey % 3 <> 0""")
def q_upsert_articles(spark, d):
    store, new = _store_and_new(spark, d)
    return art.upsert_articles(store, new).select("article_id", "title", "url")


@query("partial_update", f"""
SELECT feed_id, CASE WHEN CAST(('0x' || feed_id) AS BIGINT) % 3 = 0 THEN NULL
       ELSE {ts_sql('next_download')} END AS next_download, url FROM d_feed""")
def q_partial_update(spark, d):
    f = dt.feeds(spark, d)
    upd = (f.filter(F.conv("feed_id", 16, 10).cast("bigint") % 3 == 0)
           .select("feed_id", F.lit(None).cast("timestamp").alias("next_download")))
    out = tables.partial_update(f, upd, "feed_id", ["next_download"])
    return out.select("feed_id", ts_str("next_download").alias("next_download"), "url")


@query("feed_poll_update", f"""
, {_LATEST_POLL_SQL},
moves AS (SELECT feed_id, href, row_number() OVER (PARTITION BY feed_id ORDER BY fetched_at DESC, event_id) AS back
          FROM d_poll WHERE status = 301),
upd AS (SELECT feed_id, updated, row_number() OVER (PARTITION BY feed_id ORDER BY fetched_at DESC, event_id) AS back
        FROM d_poll WHERE updated IS NOT NULL)
SELECT f.feed_id,
  CASE WHEN m.feed_id IS NOT NULL THEN m.href ELSE f.url END AS url,
  CASE WHEN b.feed_id IS NOT NULL THEN b.href WHEN m.feed_id IS NOT NULL THEN f.url
       ELSE f.original_url END AS original_url,
  CASE WHEN p.feed_id IS NULL THEN f.bozo ELSE p.bozo END AS bozo,
  CASE WHEN p.feed_id IS NULL THEN f.status ELSE coalesce(p.status, 500) END AS status,
  CASE WHEN p.feed_id IS NULL THEN f.etag ELSE p.etag END AS etag,
  {ts_sql(f"CASE WHEN p.feed_id IS NULL THEN f.last_download ELSE {SQL_NOW} END")} AS last_download,
  {ts_sql(f"CASE WHEN p.feed_id IS NULL THEN f.next_download WHEN p.bozo = 0 THEN {SQL_NOW} + INTERVAL 1 HOUR END")} AS next_download,
  {ts_sql("coalesce(u.updated, f.updated)")} AS updated
FROM d_feed f LEFT JOIN d_last_poll p ON f.feed_id = p.feed_id
LEFT JOIN moves m ON f.feed_id = m.feed_id AND m.back = 1
LEFT JOIN moves b ON f.feed_id = b.feed_id AND b.back = 2
LEFT JOIN upd u ON f.feed_id = u.feed_id AND u.back = 1""")
def q_feed_poll_update(spark, d):
    out = feeds.feed_poll_update(dt.feeds(spark, d), dt.feed_polls(spark, d), NOW)
    return out.select("feed_id", "url", "original_url", "bozo", "status", "etag",
                      ts_str("last_download").alias("last_download"),
                      ts_str("next_download").alias("next_download"),
                      ts_str("updated").alias("updated"))


@query("advance_stage", f"""
SELECT article_id, CASE WHEN stage = 'click' THEN 'extract' ELSE stage END AS stage,
  {ts_sql(f"CASE WHEN stage = 'click' THEN {SQL_NOW} ELSE last_action END")} AS last_action
FROM d_work""")
def q_advance_stage(spark, d):
    w = dt.work(spark, d)
    out = tables.advance_stage(w, w.filter(F.col("stage") == "click"), "extract", NOW)
    return out.select("article_id", "stage", ts_str("last_action").alias("last_action"))


@query("insert_ignore", f"""
, {_ENTRY_ROWS_SQL},
fresh AS (SELECT * FROM d_entry_rows
          WHERE link NOT IN (SELECT link FROM d_work) AND article_id NOT IN (SELECT article_id FROM d_work)),
firsts AS (SELECT *, row_number() OVER (PARTITION BY link ORDER BY fetched_at, feed_id, entry_pos) AS rn FROM fresh)
SELECT article_id, link FROM firsts WHERE rn = 1""")
def q_insert_ignore(spark, d):
    e = _new_entries(spark, d).select("article_id", "link", "fetched_at", "feed_id", "entry_pos")
    e = e.withColumn("order", F.struct("fetched_at", "feed_id", "entry_pos"))
    return tables.insert_ignore(dt.work(spark, d), e, ["link", "article_id"]).select("article_id", "link")


@query("delete_by_key", f"""
, {_DUP_SQL}
SELECT pub_id, name FROM d_pub WHERE pub_id NOT IN (SELECT old_id FROM d_dups)""")
def q_delete_by_key(spark, d):
    p = dt.pubs(spark, d)
    m = pubs.duplicate_pubs(p).select(F.col("old_id").alias("pub_id"))
    return tables.delete_by_key(p, m, "pub_id").select("pub_id", "name")


@query("dead_letter", f"""
SELECT article_id, link, coalesce({_REASON_SQL}, CASE WHEN n_bytes = 0 THEN 'No HTML' END) AS reason
FROM d_page WHERE coalesce({_REASON_SQL}, CASE WHEN n_bytes = 0 THEN 'No HTML' END) IS NOT NULL""")
def q_dead_letter(spark, d):
    checked = art.has_html(art.page_validate(dt.page_fetches(spark, d), SMALL_PAGE_LIMIT))
    _ok, bad = tables.dead_letter(checked)
    return bad.select("article_id", "link", "reason")


@query("export_pubs_csv", """
SELECT pub_id AS "ID", name AS "Pub Name", homepage AS "Homepage", strftime(added, '%m/%d/%Y') AS "Added"
FROM d_pub""")
def q_export_pubs_csv(spark, d):
    """Written with the CSV sink and read back (header, MM/dd/yyyy dates)."""
    from newsdesk.sinks import export_pubs_csv
    path = _run_dir(spark, "export_pubs_csv")
    export_pubs_csv(dt.pubs(spark, d), path)
    back = spark.read.option("header", True).schema(
        "`ID` string, `Pub Name` string, `Homepage` string, `Added` string").csv(path)
    # CSV has no NULL: an empty field reads back as the empty string
    return back.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in back.columns])
