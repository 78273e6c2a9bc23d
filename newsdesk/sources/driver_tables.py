"""Domain tables derived from the driver's parquet tables (FIXTURES.md §3).

Every table here is a projection/aggregation of the given data, so its size
grows with the scale factor. The DuckDB twins of these definitions live in
``newsdesk.plans.oracle_sql`` and must stay in step with this file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsdesk.functions.dates import format_rfc1123, format_rfc3339
from newsdesk.functions.ids import id_from_number as oid

# Reference clock of the fixtures ("now" of the feed queries).
NOW = "2024-01-30 12:00:00"
RUN_TS = "2024-02-01 00:00:00"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; wall-clock (NTZ) timestamps are read as UTC instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    ntz = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    if not ntz:
        return df
    return df.select(*[F.col(c).cast("timestamp").alias(c) if c in ntz else F.col(c) for c in df.columns])


def _null(t: str):
    return F.lit(None).cast(t)


def pubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    # nation has 25 rows at every scale: a fixed-size broadcast side
    n = F.broadcast(read(spark, sf_dir, "nation"))
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    cats = (F.when(k % 8 == 0, _null("array<string>"))
             .when(k % 4 == 0, F.array().cast("array<string>"))
             .otherwise(F.array(seg, F.when(k % 2 == 0, F.lit("Health Care"))
                                       .otherwise(F.lit("health care")))))
    rules = lambda m, *xs: F.when(k % m == 0, F.array(*[F.lit(x) for x in xs]))
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        oid(k).alias("pub_id"),
        _null("bigint").alias("metabase_id"),
        F.when(k % 250 == 0, F.lit(""))
         .otherwise(F.concat(seg, F.lit("-"), F.col("c_nationkey").cast("string"))).alias("name"),
        F.concat(F.lit("http://www."), F.lower(seg), F.lit(".example.com/"), k.cast("string")).alias("homepage"),
        F.lower(seg).alias("genre"),
        F.col("c_name").alias("description"),
        F.col("n_name").alias("country"),
        F.lit(0).alias("num_articles"), F.lit(0).alias("num_feeds"),
        (k % 1000).cast("int").alias("num_readers"),
        cats.alias("categories"),
        rules(5, "-//nav", "//article").alias("xpath_body"),
        rules(6, "//span[@class='author']").alias("xpath_author"),
        rules(7, "//time~~%Y-%m-%d").alias("xpath_date"),
        rules(3, "//h1").alias("xpath_title"),
        _null("timestamp").alias("last_update"),
        F.timestamp_seconds(F.lit(1577836800) + k * 3600).alias("added"),
        F.lit(False).alias("is_new"),
        (k % 17 == 0).alias("deleted"),
    ))


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    u = F.col("user_id")
    # last poll per user: max of a struct is a partial (map-side) aggregate,
    # so a user holding a third of all events costs no single hot task
    per = ev.groupBy("user_id").agg(
        F.max(F.struct("ts", "event_id", "event_type")).alias("last"),
        F.min("ts").alias("first_ts"))
    last_ts = F.col("last.ts")
    return per.select(
        oid(u).alias("feed_id"), oid(u * 10).alias("pub_id"),
        F.when(u % 10 == 0, u).cast("bigint").alias("metabase_id"),
        F.concat(F.lit("http://feeds.example.com/"), u.cast("string"), F.lit(".xml")).alias("url"),
        _null("string").alias("original_url"),
        F.lit(0).alias("num_articles"), F.lit("rss").alias("origin"),
        _null("string").alias("genre"), _null("string").alias("etag"),
        _null("string").alias("modified"),
        F.when(u % 11 == 0, _null("int"))
         .when(F.col("last.event_type") == "error", F.lit(1)).otherwise(F.lit(0)).alias("bozo"),
        _null("int").alias("status"),
        F.col("first_ts").alias("added"),
        last_ts.alias("last_download"),
        F.when(u % 7 == 0, _null("timestamp"))
         .otherwise(last_ts + F.expr("INTERVAL 1 HOUR")).alias("next_download"),
        _null("timestamp").alias("updated"),
        (u % 13 == 0).alias("deleted"),
    )


STATUS_BY_EVENT = {"signup": 301, "view": 304, "click": 200, "error": 410}


def _status(c):
    out = None
    for k, v in STATUS_BY_EVENT.items():
        out = (F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v)))
    return out.otherwise(_null("int"))


def feed_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    e, u, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    story = F.concat(F.lit("http://news.example.com/"), (e % 5000).cast("string"), F.lit("/story"))
    ent = lambda link, who: F.struct(link.alias("link"), F.lit(who).alias("author"),
                                     F.concat(F.lit("Story "), (e % 5000).cast("string")).alias("title"),
                                     format_rfc1123(ts).alias("published"))
    return ev.select(
        oid(u).alias("feed_id"), ts.alias("fetched_at"),
        _status(F.col("event_type")).alias("status"),
        F.when(F.col("event_type") == "error", F.lit(1)).otherwise(F.lit(0)).alias("bozo"),
        F.concat(F.lit("http://feeds.example.com/"), u.cast("string"), F.lit("/moved.xml")).alias("href"),
        F.concat(F.lit('"'), e.cast("string"), F.lit('"')).alias("etag"),
        format_rfc1123(ts).alias("modified"),
        ts.alias("updated"),
        F.array(ent(story, "By Staff"),
                ent(F.concat(story, F.lit("?utm_source=rss&id="), (e % 7).cast("string")), "Desk"),
                ent(F.when(e % 10 != 0, F.concat(story, F.lit("#c"))), "Wire")).alias("entries"),
        e.alias("event_id"),
    )


ORIGIN_BY_STATUS = {"F": "webnews", "O": "lexisnexis", "P": "rss"}


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    st = F.col("o_orderstatus")
    origin = (F.when(st == "F", F.lit("webnews")).when(st == "O", F.lit("lexisnexis"))
               .otherwise(F.lit("rss")))
    return o.select(
        oid(k).alias("article_id"),
        oid(F.col("o_custkey") % 150).alias("feed_id"),
        oid(F.col("o_custkey")).alias("pub_id"),
        _null("string").alias("batch_id"),
        F.concat(F.lit("http://a.example/"), (k % 12000).cast("string")).alias("url"),
        F.concat(F.lit("Order "), k.cast("string")).alias("title"),
        F.when(k % 3 == 0, F.lit("By By Clerk")).otherwise(F.lit("Clerk")).alias("author"),
        origin.alias("origin"),
        F.col("o_orderpriority").alias("genre"),
        F.when(k % 19 == 0, _null("timestamp")).otherwise(F.col("o_orderdate")).alias("published"),
        F.repeat(F.lit("x"), (k % 13).cast("int")).alias("body_text"),
        _null("string").alias("body_html"), _null("binary").alias("html"),
        _null("bigint").alias("load_time"),
        (k % 13 == 0).alias("has_empty_body"),
        (origin == "lexisnexis").alias("is_lexisnexis"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("added"),
    )


def entry_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs plus a tracking-parameter copy of each URL without '#'."""
    p = read(spark, sf_dir, "pages").select("page_id", F.col("url").alias("link"))
    variant = (p.filter(~F.col("link").contains("#")).select(
        (F.col("page_id") + 1000000).alias("page_id"),
        F.concat(F.col("link"),
                 F.when(F.col("link").contains("?"), F.lit("&")).otherwise(F.lit("?")),
                 F.lit("utm_campaign=x&fbclid=1&CMP=a")).alias("link")))
    return p.unionByName(variant)


def work(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    e, u = F.col("event_id"), F.col("user_id")
    return ev.select(
        oid(e).alias("article_id"), oid(u).alias("feed_id"), oid(u * 10).alias("pub_id"),
        F.concat(F.lit("http://news.example.com/"), (e % 5000).cast("string"), F.lit("/story")).alias("link"),
        F.col("event_type").alias("stage"), F.col("ts").alias("started"),
        F.col("ts").alias("last_action"))


def page_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "pages")
    i = F.col("page_id")
    fetched = F.timestamp_seconds(F.lit(1704067200) + i * 60)
    pub = (F.when(i % 4 == 1, F.concat(F.date_format(fetched, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" -0700")))
            .when(i % 4 == 2, F.lit("yesterday"))
            .otherwise(format_rfc1123(fetched)))
    return p.select(
        oid(i).alias("article_id"), oid(i % 15).alias("feed_id"), oid(i % 150).alias("pub_id"),
        F.col("url").alias("link"),
        F.when(i % 40 == 7, F.concat(F.lit("/moved/"), i.cast("string"))).alias("location"),
        F.when(i % 50 == 0, F.lit("audio/mpeg")).otherwise(F.lit("text/html")).alias("content_type"),
        F.when(i % 45 == 0, F.lit(b"").cast("binary"))
         .otherwise(F.encode(F.col("html"), "UTF-8")).alias("html"),
        fetched.alias("fetched_at"),
        _null("string").alias("author"), _null("string").alias("title"),
        pub.alias("published"))


def text_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article bodies from ``documents``: pub = source, feed = source/lang."""
    d = read(spark, sf_dir, "documents")
    return d.select(
        oid(F.col("doc_id")).alias("article_id"),
        F.col("source").alias("pub_id"),
        F.concat(F.col("source"), F.lit("/"), F.col("lang")).alias("feed_id"),
        F.col("text").alias("body_text"))


def wire_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that newswire articles are made of, narrow: what moves the
    articles moves these, and makes the articles last (``wire_articles_of``)."""
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer")
    n = F.broadcast(read(spark, sf_dir, "nation"))
    j = o.join(c, o.o_custkey == c.c_custkey, "left").join(n, F.col("c_nationkey") == n.n_nationkey, "left")
    return j.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "c_name", "c_mktsegment", "n_name")


def wire_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newswire articles as nested structs (to be rendered to XML)."""
    return wire_articles_of(wire_orders(spark, sf_dir))


def wire_articles_of(orders: DataFrame) -> DataFrame:
    """order_key and the article of each row of ``wire_orders``."""
    k = F.col("o_orderkey")
    fid = F.col("o_custkey") % 50
    return orders.select(
        k.alias("order_key"),
        F.struct(
            k.cast("string").alias("sequenceId"),
            F.concat(F.lit("w"), k.cast("string")).alias("id"),
            F.concat(F.lit("Wire "), k.cast("string")).alias("title"),
            F.repeat(F.lit("y"), (k % 17).cast("int")).alias("content"),
            F.when(k % 9 == 4, F.lit("2014-11-20")).otherwise(format_rfc3339(F.col("o_orderdate"))).alias("publishedDate"),
            format_rfc3339(F.col("o_orderdate") + F.expr("INTERVAL 2 HOURS")).alias("harvestDate"),
            F.concat(F.lit("http://wire.example.com/"), k.cast("string")).alias("url"),
            F.when(k % 3 == 0, F.lit(""))
             .otherwise(F.concat(F.lit("http://orig.example.com/"), k.cast("string"))).alias("originalUrl"),
            F.struct(F.when(k % 5 == 0, F.concat(F.lit("LNI-"), k.cast("string")))
                     .otherwise(F.lit("")).alias("itemId")).alias("publishingPlatform"),
            F.struct(F.when(k % 2 == 0, F.concat(F.lit("By By "), F.col("c_name")))
                     .otherwise(F.col("c_name")).alias("name")).alias("author"),
            F.struct(
                F.struct(F.col("n_name").alias("country")).alias("location"),
                F.struct(fid.alias("id"),
                         F.concat(F.lit("Wire feed "), fid.cast("string")).alias("name"),
                         F.col("o_orderpriority").alias("genre"),
                         F.struct(F.array(F.col("c_mktsegment"), F.lit("News")).alias("editorialTopic"))
                          .alias("editorialTopics")).alias("feed"),
            ).alias("source"),
        ).alias("article"))
