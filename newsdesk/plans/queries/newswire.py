"""Registered queries: the newswire path."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from newsdesk.functions import dates, text
from newsdesk.operators import feeds, wire
from newsdesk.plans.common import _LINKS_SQL, _WIRE_URL_SQL, _run_dir, _wire, _wire_links
from newsdesk.plans.registry import RUN_TS, query, ts_sql, ts_str
from newsdesk.sources import driver_tables as dt


@query("wire_parents", f"""
, {_LINKS_SQL}
SELECT metabase_id, pub_id, feed_id, created FROM d_wire_links""")
def q_wire_parents(spark, d):
    _p, _f, links = _wire_links(spark, d)
    return links.select("metabase_id", "pub_id", "feed_id", "created")


@query("wire_to_article", f"""
, {_LINKS_SQL}
SELECT w.seq, {_WIRE_URL_SQL} AS url, w.title,
  regexp_replace(w.author_name, '^(By ){{1,2}}', '') AS author, w.genre,
  {ts_sql("CASE WHEN w.seq % 9 = 4 THEN w.published_ts + INTERVAL 2 HOUR ELSE w.published_ts END")} AS published,
  octet_length(encode(w.content)) < 10 AS has_empty_body, 'webnews' AS origin,
  l.pub_id, l.feed_id, coalesce(w.content, '') AS body_text, false AS is_lexisnexis, w.wid AS metabase_id, w.lni AS metabase_lni,
  w.published_date AS metabase_published, w.url AS metabase_url, w.country
FROM d_wire w LEFT JOIN d_wire_links l ON w.wire_feed_id = l.metabase_id""")
def q_wire_to_article(spark, d):
    from newsdesk.plans.wire import ingest_wire
    # parents and articles both read the parsed batch: ingest_wire parses
    # the XML once (persist keeps lineage; a lost executor recomputes)
    _p, _f, a, _cached = ingest_wire(_wire(spark, d, mapped=False), dt.feeds(spark, d), RUN_TS)
    m = lambda c: F.col(f"metabase.{c}")
    return a.select(F.col("metabase.sequence_id").cast("bigint").alias("seq"), "url", "title", "author",
                    "genre", ts_str("published").alias("published"), "has_empty_body", "origin",
                    "pub_id", "feed_id", F.coalesce("body_text", F.lit("")).alias("body_text"), "is_lexisnexis",
                    m("id").alias("metabase_id"), F.nullif(m("lni"), F.lit("")).alias("metabase_lni"),
                    m("published_date").alias("metabase_published"), m("url").alias("metabase_url"),
                    # from the kept XML, which is the whole article
                    F.regexp_extract(F.decode("html", "UTF-8"), "<country>([^<]*)</country>", 1).alias("country"))


@query("wire_url", f"""
SELECT seq, {_WIRE_URL_SQL} AS url FROM d_wire""")
def q_wire_url(spark, d):
    return _wire(spark, d).select("seq", wire.wire_url("a").alias("url"))


@query("wire_cursor", """
SELECT seq // 500 AS batch, CAST(arg_max(seq, (seq * 7919) % 100003) AS VARCHAR) AS sequence_id FROM d_wire GROUP BY seq // 500""")
def q_wire_cursor(spark, d):
    """Batches landed in an order that is not that of their numbers and read
    with the place of each article in its document."""
    from newsdesk.plans.wire import wire_rows_from_files
    from newsdesk.sources.wire import read_wire
    path = _run_dir(spark, "wire_cursor")
    w = dt.wire_orders(spark, d).withColumn("batch", (F.col("o_orderkey") / 500).cast("bigint"))
    w = w.repartitionByRange("batch").sortWithinPartitions("batch", (F.col("o_orderkey") * 7919) % 100003)
    (dt.wire_articles_of(w).select("article.*")
     .write.format("xml").option("rowTag", "article").option("rootTag", "articles").save(path))
    found = wire_rows_from_files(read_wire(spark, path, with_file=False, mapped=True, with_position=True))
    return wire.wire_cursor(found.withColumn("batch", (F.col("seq") / 500).cast("bigint")), "batch", "pos")


@query("wire_batch_stats", f"""
, {_LINKS_SQL}
SELECT seq // 500 AS batch, count(*) AS articles, count(*) - count(DISTINCT wire_feed_id) AS hits,
  count(DISTINCT wire_feed_id) AS misses,
  count(DISTINCT CASE WHEN wire_feed_id IN (SELECT metabase_id FROM d_wire_links WHERE created) THEN wire_feed_id END) AS created
FROM d_wire GROUP BY seq // 500""")
def q_wire_batch_stats(spark, d):
    w = (_wire(spark, d).withColumn("batch", (F.col("seq") / 500).cast("bigint"))
         .persist(StorageLevel.MEMORY_AND_DISK))
    _p, _f, links = _wire_links(spark, d, w)
    return wire.wire_batch_stats(w, links, "batch")


@query("parse_rfc3339", f"""
SELECT seq, {ts_sql("CASE WHEN seq % 9 = 4 THEN published_ts + INTERVAL 2 HOUR ELSE published_ts END")} AS published
FROM d_wire""")
def q_parse_rfc3339(spark, d):
    w = _wire(spark, d)
    p = dates.parse_rfc3339(F.col("a.publishedDate"), F.col("a.harvestDate"), F.lit(RUN_TS).cast("timestamp"))
    return w.select("seq", ts_str(p).alias("published"))


@query("clean_author", """
SELECT seq, regexp_replace(author_name, '^(By ){1,2}', '') AS author FROM d_wire""")
def q_clean_author(spark, d):
    return _wire(spark, d).select("seq", text.clean_author(F.col("a.author.name")).alias("author"))
