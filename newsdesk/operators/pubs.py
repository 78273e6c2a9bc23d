"""Publication upkeep: duplicate merge, repointing, per-pub lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsdesk.functions.text import size0
from newsdesk.operators.tables import delete_by_key, small

from newsdesk.fixed import WIRE_ORIGINS


def pubs_by_name(pubs: DataFrame) -> DataFrame:
    """Name, then id, bytewise (Spark's default string order is binary)."""
    return pubs.orderBy("name", "pub_id")


def duplicate_pubs(pubs: DataFrame) -> DataFrame:
    """Map (old_id -> new_id) for every pub sharing its name with a pub of
    smaller id; the smallest id of a name survives. Empty names form a
    group too; the group sorting last is not lost.

    Survivors come from a grouped min (partial aggregate, skew-safe), joined
    back on name: the right side has one row per name."""
    survivors = (pubs.groupBy("name")
                 .agg(F.min("pub_id").alias("new_id"), F.count("*").alias("_n"))
                 .filter(F.col("_n") > 1).drop("_n"))
    return (pubs.select("name", F.col("pub_id").alias("old_id"))
            .join(survivors, "name", "inner")
            .filter(F.col("old_id") != F.col("new_id"))
            .select("old_id", "new_id", "name"))


def pub_repoint(children: DataFrame, id_map: DataFrame) -> DataFrame:
    """Rewrite pub_id of feeds or articles through the old -> new map. All
    children move (no page-size cut)."""
    m = id_map.select(F.col("old_id").alias("pub_id"), F.col("new_id").alias("_new"))
    cols = children.columns
    return (children.join(m, "pub_id", "left")
            .withColumn("pub_id", F.coalesce(F.col("_new"), F.col("pub_id")))
            .select(*cols))


def merge_publications(pubs: DataFrame, feeds: DataFrame, articles: DataFrame):
    """Duplicate pubs folded into their survivor: (pubs, feeds, articles)."""
    m = duplicate_pubs(pubs)
    new_pubs = delete_by_key(pubs, m.select(F.col("old_id").alias("pub_id")), "pub_id")
    return new_pubs, pub_repoint(feeds, m), pub_repoint(articles, m)


def pub_feed_count(feeds: DataFrame, include_deleted: bool = False) -> DataFrame:
    f = feeds if include_deleted else feeds.filter(~F.coalesce(F.col("deleted"), F.lit(False)))
    return f.groupBy("pub_id").agg(F.count("*").cast("int").alias("num_feeds"))


def pubs_missing_categories(pubs: DataFrame) -> DataFrame:
    return pubs.filter(size0("categories") == 0)


def pubs_with_categories(pubs: DataFrame) -> DataFrame:
    return pubs.filter(size0("categories") > 0)


def wire_origin_filter(articles: DataFrame) -> DataFrame:
    return articles.filter(F.col("origin").isin(WIRE_ORIGINS))


def latest_article_per_pub(articles: DataFrame, origins=WIRE_ORIGINS) -> DataFrame:
    """Newest article (largest id) per pub among the given origins, as a
    grouped max of a struct: combined map-side, so a pub with a third of all
    articles is no single hot task. Pass only the columns needed: the
    struct carries them all through the shuffle."""
    a = articles if origins is None else articles.filter(F.col("origin").isin(list(origins)))
    rest = [c for c in a.columns if c not in ("pub_id", "article_id")]
    return (a.groupBy("pub_id")
             .agg(F.max(F.struct("article_id", *rest)).alias("_m"))
             .select("pub_id", "_m.*"))


def pub_category_backfill(pubs: DataFrame, articles: DataFrame, parse_xml) -> DataFrame:
    """Pubs without categories take categories, country and genre from the
    newswire XML of their newest wire article. ``parse_xml`` maps the
    article's html column to the newswire struct (see ``sources.wire``).
    Returns the updated pub table."""
    need = pubs_missing_categories(pubs).select("pub_id")
    # the newest id per pub is found on the narrow (pub_id, article_id)
    # columns; the XML of those articles (one per pub) is fetched by id after
    latest = latest_article_per_pub(
        articles.join(need, "pub_id", "left_semi").select("pub_id", "article_id", "origin"))
    # by the ids of these (one for a pub, broadcast when measured small), so
    # that no other XML is shuffled; an id stored twice gives one row
    xml = (articles.select("article_id", "html").join(small(latest.select("article_id")), "article_id", "left_semi")
           .groupBy("article_id").agg(F.max("html").alias("html")))
    w = latest.join(xml, "article_id").select("pub_id", parse_xml(F.col("html")).alias("w"))
    # XML that can't be read has no source: the pub keeps its values
    upd = w.filter(F.col("w.source").isNotNull()).select(
        "pub_id",
        F.col("w.source.feed.editorialTopics.editorialTopic").alias("_cats"),
        F.col("w.source.location.country").alias("_country"),
        F.col("w.source.feed.genre").alias("_genre"),
        F.lit(True).alias("_hit"))
    j = pubs.join(upd, "pub_id", "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    repl = {"categories": "_cats", "country": "_country", "genre": "_genre"}
    return j.select(*[F.when(hit, F.col(repl[c])).otherwise(F.col(c)).alias(c) if c in repl else F.col(c)
                      for c in pubs.columns])


def soft_delete(table: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """deleted = true for the listed ids."""
    hit = ids.select(key).distinct().withColumn("_del", F.lit(True))
    return (table.join(hit, key, "left")
            .withColumn("deleted", F.coalesce(F.col("_del"), F.col("deleted"), F.lit(False)))
            .select(*table.columns))


def soft_delete_feeds(pubs: DataFrame, feeds: DataFrame, feed_ids: DataFrame):
    """Delete feeds softly and lower num_feeds of their pubs by the number
    of feeds newly deleted. Returns (pubs, feeds)."""
    ids = feed_ids.select("feed_id").distinct()
    newly = (feeds.join(ids, "feed_id", "left_semi")
             .filter(~F.coalesce(F.col("deleted"), F.lit(False)))
             .groupBy("pub_id").agg(F.count("*").cast("int").alias("_dec")))
    new_pubs = (pubs.join(newly, "pub_id", "left")
                .withColumn("num_feeds", F.col("num_feeds") - F.coalesce(F.col("_dec"), F.lit(0)))
                .select(*pubs.columns))
    return new_pubs, soft_delete(feeds, ids, "feed_id")
