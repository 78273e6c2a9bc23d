"""Flagship: fetched pages -> cleaned URL -> URL de-duplication -> article
counts per publication and feed."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from newsdesk.functions.ids import id_from_number as oid
from newsdesk.functions.urls import clean_url
from newsdesk.operators.articles import new_articles
from newsdesk.operators.counts import article_counts
from newsdesk.sources import driver_tables as dt


def page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article per landed link (pages plus their tracking-parameter
    copies); a copy belongs to the same pub and feed as its page."""
    links = dt.entry_links(spark, sf_dir)
    base = F.col("page_id") % 1000000
    return links.select(oid(F.col("page_id")).alias("article_id"),
                        oid(base % 150).alias("pub_id"), oid(base % 15).alias("feed_id"),
                        clean_url("link").alias("url"))


def rss_article_counts(spark: SparkSession, sf_dir: str, store: DataFrame | None = None) -> DataFrame:
    # the URL judgement reads the batch three times (rows, first id per url,
    # urls to filter the store): clean the URLs once
    batch = page_articles(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    if store is None:
        store = spark.createDataFrame([], "article_id string, url string")   # nothing stored yet
    keep, _dups = new_articles(batch, store)
    return article_counts(keep)
