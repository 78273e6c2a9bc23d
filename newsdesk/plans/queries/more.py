"""Registered queries: further inventory items."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsdesk.functions import text
from newsdesk.operators import categories, pubs, work, wire
from newsdesk.plans.common import _WIRE_URL_SQL, _run_dir, _wire, _wire_links
from newsdesk.plans.fixture_sql import make_id as sql_make_id
from newsdesk.plans.registry import RUN_TS, query, ts_str
from newsdesk.sources import driver_tables as dt
from newsdesk.sources.wire import render_wire


@query("category_key", """
SELECT DISTINCT c AS category, replace(c, ' ', '') AS key FROM (SELECT unnest(categories) AS c FROM d_pub)""")
def q_category_key(spark, d):
    c = dt.pubs(spark, d).select(F.explode("categories").alias("category")).distinct()
    return c.select("category", text.category_key("category").alias("key"))


@query("name_order", """
SELECT pub_id, name FROM d_pub ORDER BY name, pub_id""")
def q_name_order(spark, d):
    return pubs.pubs_by_name(dt.pubs(spark, d)).select("pub_id", "name")


@query("archive_wire", """
SELECT o_orderkey AS order_key, strftime(TIMESTAMP '2024-02-01 00:00:00' + to_hours(o_orderkey // 500), '%Y-%m-%d') AS fetch_date,
  strftime(TIMESTAMP '2024-02-01 00:00:00' + to_hours(o_orderkey // 500), '%Y-%m-%d %H:%M:%S') AS fetched_at,
  CAST(o_orderkey AS VARCHAR) AS sequence_id, true AS whole FROM orders""")
def q_archive_wire(spark, d):
    """Raw responses archived under their fetch date, read back per date."""
    from newsdesk.sources.wire import archive_wire
    # one fetch per batch of 500 articles, an hour apart
    o = dt.read(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        (F.lit(RUN_TS).cast("timestamp")
         + F.make_interval(hours=(F.col("o_orderkey") / 500).cast("int"))).alias("fetched_at"))
    raw = dt.wire_rows(spark, d).select("order_key", render_wire(F.col("article")).alias("raw"))
    path = _run_dir(spark, "archive_wire")
    archive_wire(raw.join(o, "order_key"), path)
    back = spark.read.parquet(path)
    same = raw.select("order_key", F.xxhash64("raw").alias("hash")).join(
        back.withColumn("found", F.xxhash64("raw")), "order_key", "right")
    return same.select("order_key", F.date_format("fetch_date", "yyyy-MM-dd").alias("fetch_date"), ts_str("fetched_at").alias("fetched_at"),
                       F.regexp_extract("raw", "<sequenceId>([^<]*)<", 1).alias("sequence_id"), (F.col("hash") == F.col("found")).alias("whole"))


@query("union_sources", f"""
SELECT article_id, link AS url, 'rss' AS origin, NULL::VARCHAR AS sequence_id FROM d_page
UNION ALL SELECT {sql_make_id(f"TIMESTAMP '{RUN_TS}'", 'wid', 'seq')}, {_WIRE_URL_SQL}, 'webnews', CAST(seq AS VARCHAR) FROM d_wire""")
def q_union_sources(spark, d):
    """Feed articles (from pages) and newswire articles land in one table;
    columns missing on one side are NULL."""
    rss = dt.page_fetches(spark, d).select("article_id", F.col("link").alias("url"), F.lit("rss").alias("origin"))
    w = _wire(spark, d)
    _p, _f, links = _wire_links(spark, d, w)
    wa = wire.wire_to_article(w, links, False, RUN_TS).select("article_id", "url", "origin", "metabase")
    both = rss.unionByName(wa, allowMissingColumns=True)
    return both.select("article_id", "url", "origin", F.col("metabase.sequence_id").alias("sequence_id"))


@query("decode_work_data", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def q_decode_work_data(spark, d):
    """The JSON blob of a work row decoded with an explicit schema."""
    ev = dt.read(spark, d, "events")
    return ev.select("event_id", F.from_json("props", "k INT").getField("k").alias("k"))
