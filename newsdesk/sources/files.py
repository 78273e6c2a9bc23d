"""File sources: landed feed polls, fetched pages, legacy catalogue dump."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsdesk import schema as S
from newsdesk.functions.dates import not_zero_time
from newsdesk.functions.ids import objectid_time


def read_feed_fetches(spark: SparkSession, path: str, fmt: str = "json", stream: bool = False) -> DataFrame:
    """Landed poll results (feed_id, status, bozo, href, etag, modified,
    updated, entries[]) with an explicit schema, batch or stream."""
    r = spark.readStream if stream else spark.read
    return r.schema(S.FEED_POLL).format(fmt).load(path)


def read_page_fetches(spark: SparkSession, path: str, fmt: str = "parquet", stream: bool = False) -> DataFrame:
    """Landed page fetches (entry ids, link, location, content type, html)."""
    r = spark.readStream if stream else spark.read
    return r.schema(S.PAGE_FETCH).format(fmt).load(path)


def read_legacy_pubs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Legacy catalogue dump (JSON lines, one publication with its feeds per
    line) -> (pubs, feeds). num_feeds = number of listed feeds; the XPath
    lists are copied; creation times come from the ids."""
    raw = spark.read.schema(S.LEGACY_PUB).json(path)
    pubs = raw.select(
        F.lower("ID").alias("pub_id"), F.col("Title").alias("name"), F.col("URL").alias("homepage"),
        F.col("NumReaders").alias("num_readers"),
        F.coalesce(F.size("Feeds"), F.lit(0)).cast("int").alias("num_feeds"),
        not_zero_time("Updated").alias("last_update"),
        F.col("XPaths.Author").alias("xpath_author"), F.col("XPaths.Body").alias("xpath_body"),
        F.col("XPaths.Date").alias("xpath_date"), F.col("XPaths.Title").alias("xpath_title"),
        objectid_time(F.lower("ID")).alias("added"))
    feeds = raw.select(F.lower("ID").alias("pub_id"), F.explode("Feeds").alias("f")).select(
        F.lower("f.ID").alias("feed_id"), "pub_id", F.col("f.URL").alias("url"),
        objectid_time(F.lower("f.ID")).alias("added"))
    return pubs, feeds
