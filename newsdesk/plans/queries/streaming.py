"""Registered queries: streaming jobs (inputs landed, availableNow)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsdesk.operators import feeds, pubs
from newsdesk.plans.common import (
    _COUNTS_SQL, _ENTRY_ROWS_SQL, _LINKS_SQL, _WIRE_URL_SQL, _land, _run_dir, _wire_files)
from newsdesk.plans.registry import RUN_TS, query, ts_sql, ts_str
from newsdesk.sources import driver_tables as dt


#: Response files that one micro-batch of the newswire query takes for each core:
#: with so many for all, the fixed cost of a micro-batch was most of the run.
WIRE_FILES_A_BATCH = 100


@query("stream_article_counts", _COUNTS_SQL)
def q_stream_article_counts(spark, d):
    import os
    from newsdesk.streaming import jobs
    base = _run_dir(spark, "stream_article_counts")
    a = dt.articles(spark, d).select("article_id", "pub_id", "feed_id")
    _land(a, os.path.join(base, "in"), "article_id")
    q = jobs.stream_article_counts(spark, os.path.join(base, "in"), os.path.join(base, "out"),
                                   os.path.join(base, "ck"), schema=a.schema, max_files=1)
    q.awaitTermination()
    return jobs.current_counts(spark, os.path.join(base, "out"))


@query("stream_feed_entries", f"""
, {_ENTRY_ROWS_SQL},
firsts AS (SELECT *, row_number() OVER (PARTITION BY link ORDER BY fetched_at, feed_id, entry_pos) AS rn FROM d_entry_rows)
SELECT article_id, feed_id, {ts_sql('fetched_at')} AS fetched_at, CAST(entry_pos AS INTEGER) AS entry_pos, link, author,
  'Story ' || CAST(event_id % 5000 AS VARCHAR) AS title, modified AS published FROM firsts WHERE rn = 1""")
def q_stream_feed_entries(spark, d):
    import os
    from newsdesk.streaming import jobs
    base = _run_dir(spark, "stream_feed_entries")
    _land(dt.feed_polls(spark, d), os.path.join(base, "in"), "fetched_at")
    q = jobs.stream_feed_entries(spark, os.path.join(base, "in"), os.path.join(base, "out"),
                                 os.path.join(base, "ck"))
    q.awaitTermination()
    return spark.read.parquet(os.path.join(base, "out")).select(
        "article_id", "feed_id", ts_str("fetched_at").alias("fetched_at"), F.col("entry_pos").cast("int").alias("entry_pos"),
        "link", "author", "title", "published")


@query("stream_wire", f"""
, {_LINKS_SQL}
SELECT w.seq, {_WIRE_URL_SQL} AS url, w.title, regexp_replace(w.author_name, '^(By ){{1,2}}', '') AS author, w.genre,
  {ts_sql("CASE WHEN w.seq % 9 = 4 THEN w.published_ts + INTERVAL 2 HOUR ELSE w.published_ts END")} AS published,
  octet_length(encode(w.content)) < 10 AS has_empty_body, 'webnews' AS origin, l.pub_id, l.feed_id
FROM d_wire w LEFT JOIN d_wire_links l ON w.wire_feed_id = l.metabase_id""")
def q_stream_wire(spark, d):
    import os
    from newsdesk.streaming import jobs
    base = _run_dir(spark, "stream_wire")
    q = jobs.stream_wire(spark, _wire_files(spark, d), dt.feeds(spark, d), os.path.join(base, "out"),
                         os.path.join(base, "ck"), RUN_TS, max_files=WIRE_FILES_A_BATCH * spark.sparkContext.defaultParallelism)
    q.awaitTermination()
    a = spark.read.parquet(os.path.join(base, "out", "articles"))
    return a.select(F.col("metabase.sequence_id").cast("bigint").alias("seq"), "url", "title", "author", "genre",
                    ts_str("published").alias("published"), "has_empty_body", "origin", "pub_id", "feed_id")


@query("stream_articles", f"""
SELECT g.article_id, g.feed_id, g.pub_id, 'rss' AS origin, g.link AS entry_url FROM d_page g JOIN d_pub p ON g.pub_id = p.pub_id
WHERE g.content_type <> 'audio/mpeg' AND g.n_bytes > 0 AND g.n_bytes < 2097152""")
def q_stream_articles(spark, d):
    import os
    from newsdesk.streaming import jobs
    base = _run_dir(spark, "stream_articles")
    _land(dt.page_fetches(spark, d), os.path.join(base, "in"), "fetched_at")
    q = jobs.stream_articles(spark, os.path.join(base, "in"), dt.pubs(spark, d),
                             os.path.join(base, "store"), os.path.join(base, "ck"))
    q.awaitTermination()
    return spark.read.parquet(os.path.join(base, "store")).select(
        "article_id", "feed_id", "pub_id", "origin", F.col("entry.url").alias("entry_url"))
