"""Article counts per pub and per feed, full and incremental."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _emit(articles: DataFrame) -> DataFrame:
    """Two rows per article: (pub, pub_id) and (feed, feed_id)."""
    return articles.select(F.expr("stack(2, 'pub', pub_id, 'feed', feed_id) AS (type, id)"))


def article_counts(articles: DataFrame) -> DataFrame:
    """(type, id, n). The aggregate runs partial then final, so a pub with a
    third of all articles is summed map-side first."""
    return _emit(articles).groupBy("type", "id").agg(F.count("*").alias("n"))


def article_id_watermark(articles: DataFrame) -> DataFrame:
    """(n, last_id): count and largest id. n = 0 means nothing to do."""
    return articles.agg(F.count("*").alias("n"), F.max("article_id").alias("last_id"))


def article_counts_incremental(counts: DataFrame, articles: DataFrame, last_id: str | None,
                               upto_id: str | None = None) -> DataFrame:
    """Counts after adding the articles with last_id < id <= upto_id to the
    stored counts (added, not replaced). The new cursor is ``upto_id``
    (the watermark of the same read)."""
    a = articles
    if last_id is not None:
        a = a.filter(F.col("article_id") > F.lit(last_id))
    if upto_id is not None:
        a = a.filter(F.col("article_id") <= F.lit(upto_id))
    inc = article_counts(a)
    return (counts.select("type", "id", "n").unionByName(inc)
            .groupBy("type", "id").agg(F.sum("n").cast("bigint").alias("n")))


def apply_counts(table: DataFrame, counts: DataFrame, kind: str, key: str) -> DataFrame:
    """Set num_articles of pubs (kind 'pub', key pub_id) or feeds from the
    counts; ids without articles get 0."""
    c = counts.filter(F.col("type") == kind).select(F.col("id").alias(key), F.col("n").alias("_n"))
    return (table.join(c, key, "left")
            .withColumn("num_articles", F.coalesce(F.col("_n"), F.lit(0)).cast("int"))
            .select(*table.columns))


def last_article(articles: DataFrame) -> DataFrame:
    return articles.agg(F.max("article_id").alias("last_id"))
