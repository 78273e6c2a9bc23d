"""Newswire path: parents (pub/feed per wire feed), article mapping, cursor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsdesk.functions.dates import parse_rfc3339
from newsdesk.functions.ids import make_id
from newsdesk.functions.text import clean_author, nullif_empty
from newsdesk.operators.tables import dedupe_first

VIEW_LINK_BASE = "http://www.example.com/view/"
FEED_URL_TEMPLATE = "http://www.example.com/feed/%d.xml"
from newsdesk.fixed import WIRE_BODY_MIN_BYTES, WIRE_ORIGINS


def _ts(x):
    return F.lit(x).cast("timestamp") if not isinstance(x, Column) else x


def wire_origin(is_lexisnexis: bool) -> str:
    return WIRE_ORIGINS[1] if is_lexisnexis else WIRE_ORIGINS[0]


def wire_url(a: str = "a", link_base: str = VIEW_LINK_BASE) -> Column:
    """Original url, else url; an item id (LNI) makes a view link that wins."""
    lni = nullif_empty(F.col(f"{a}.publishingPlatform.itemId"))
    return F.coalesce(F.when(lni.isNotNull(), F.concat(F.lit(link_base), lni)),
                      nullif_empty(F.col(f"{a}.originalUrl")), F.col(f"{a}.url"))


def feed_key(a: str = "a") -> Column:
    """Wire feed id of an article; a missing id is 0, as a numeric decode of
    the format gives. (No NULL filter is needed, which matters when the
    article comes from ``from_xml``: a filter pushed under the projection
    would parse every article a second time.)"""
    return F.coalesce(F.col(f"{a}.source.feed.id"), F.lit(0).cast("bigint"))


def wire_parents(wire: DataFrame, feeds: DataFrame, is_lexisnexis: bool, run_ts,
                 a: str = "a", order: str = "seq"):
    """(new_pubs, new_feeds, links) of ``resolved_parents``."""
    return resolved_parents(wire, feeds, is_lexisnexis, run_ts, a, order)[:3]


def resolved_parents(wire: DataFrame, feeds: DataFrame, is_lexisnexis: bool, run_ts,
                     a: str = "a", order: str = "seq"):
    """Resolve each wire feed id to (pub_id, feed_id).

    Known ids come from the feed table (smallest feed_id if several); the
    others get one new pub and one new feed built from the first article
    (by ``order``) carrying that id. Ids are deterministic, so a replay
    creates nothing twice. Returns (new_pubs, new_feeds, links, parents) with
    links(metabase_id, pub_id, feed_id, created); the three are projections of
    ``parents``, which has one row for each wire feed."""
    fid = feed_key(a)
    firsts = dedupe_first(
        wire.select(fid.alias("metabase_id"), F.col(order).alias("_ord"),
                    F.col(f"{a}.source.feed.name").alias("name"),
                    F.col(f"{a}.source.feed.editorialTopics.editorialTopic").alias("categories"),
                    F.col(f"{a}.source.location.country").alias("country"),
                    F.col(f"{a}.source.feed.description").alias("description"),
                    F.col(f"{a}.source.feed.genre").alias("genre")),
        "metabase_id", ["_ord"])
    known = (feeds.filter(F.col("metabase_id").isNotNull())
             .groupBy("metabase_id")
             .agg(F.min(F.struct("feed_id", "pub_id")).alias("_f"))
             .select("metabase_id", F.col("_f.pub_id").alias("pub_id"),
                     F.col("_f.feed_id").alias("feed_id")))
    j = firsts.join(known, "metabase_id", "left")
    created = F.col("feed_id").isNull()
    new_pub_id = make_id(_ts(run_ts), F.lit("pub"), F.col("metabase_id"))
    new_feed_id = make_id(_ts(run_ts), F.lit("feed"), F.col("metabase_id"))
    j = j.select("*", created.alias("created"),
                 F.coalesce("pub_id", new_pub_id).alias("_pub"),
                 F.coalesce("feed_id", new_feed_id).alias("_feed"))
    origin = wire_origin(is_lexisnexis)
    fresh = j.filter("created")
    new_pubs = fresh.select(
        F.col("_pub").alias("pub_id"), F.col("metabase_id"), "name", "description", "country",
        "categories", F.lit(1).alias("num_feeds"), _ts(run_ts).alias("added"))
    new_feeds = fresh.select(
        F.col("_feed").alias("feed_id"), F.col("_pub").alias("pub_id"), "metabase_id",
        F.format_string(FEED_URL_TEMPLATE, F.col("metabase_id")).alias("url"),
        "genre", F.lit(origin).alias("origin"), _ts(run_ts).alias("added"))
    links = j.select("metabase_id", F.col("_pub").alias("pub_id"), F.col("_feed").alias("feed_id"),
                     "created")
    return new_pubs, new_feeds, links, j


def wire_to_article(wire: DataFrame, links: DataFrame, is_lexisnexis: bool, run_ts,
                    a: str = "a", xml_col: str | None = None,
                    link_base: str = VIEW_LINK_BASE, batch_name: str = "batch") -> DataFrame:
    """Newswire rows -> article rows (article schema, metabase struct set)."""
    run = _ts(run_ts)
    author = clean_author(F.col(f"{a}.author.name"))
    origin = wire_origin(is_lexisnexis)
    w = wire.join(links.select(F.col("metabase_id").alias("_mid"), "pub_id", "feed_id"),
                  feed_key(a) == F.col("_mid"), "left")
    meta = F.struct(
        author.alias("author"),
        F.col(f"{a}.author.homeUrl").alias("author_home_url"),
        F.col(f"{a}.author.email").alias("author_email"),
        F.col(f"{a}.sequenceId").alias("sequence_id"),
        F.col(f"{a}.id").alias("id"),
        F.col(f"{a}.publishingPlatform.itemId").alias("lni"),
        F.col(f"{a}.publishedDate").alias("published_date"),
        F.col(f"{a}.harvestDate").alias("harvest_date"),
        F.col(f"{a}.embargoDate").alias("embargo_date"),
        F.col(f"{a}.licenseEndDate").alias("license_end_date"),
        F.col(f"{a}.contentLicenseEndDate").alias("content_license_end_date"),
        F.col(f"{a}.url").alias("url"),
        F.col(f"{a}.originalUrl").alias("original_url"))
    # raw XML kept as the article's html; without the raw text (XML file
    # source) the parsed article is serialised back, as the reference does
    xml = F.col(xml_col) if xml_col else F.to_xml(F.col(a), {"rowTag": "article"})
    html = F.encode(xml, "UTF-8")
    return w.select(
        make_id(run, F.col(f"{a}.id"), F.col(f"{a}.sequenceId")).alias("article_id"),
        "feed_id", "pub_id",
        make_id(run, F.lit(batch_name)).alias("batch_id"),
        wire_url(a, link_base).alias("url"),
        F.col(f"{a}.title").alias("title"),
        author.alias("author"),
        F.lit(origin).alias("origin"),
        F.col(f"{a}.source.feed.genre").alias("genre"),
        parse_rfc3339(F.col(f"{a}.publishedDate"), F.col(f"{a}.harvestDate"), run).alias("published"),
        F.col(f"{a}.content").alias("body_text"),
        F.col(f"{a}.contentWithMarkup").alias("body_html"),
        html.alias("html"),
        F.lit(None).cast("bigint").alias("load_time"),
        (F.coalesce(F.octet_length(F.col(f"{a}.content")), F.lit(0)) < WIRE_BODY_MIN_BYTES).alias("has_empty_body"),
        F.lit(is_lexisnexis).alias("is_lexisnexis"),
        run.alias("added"),
        meta.alias("metabase"))


def wire_cursor(wire: DataFrame, batch_col: str, pos_col: str, a: str = "a") -> DataFrame:
    """Last sequence id in document order of each batch (file)."""
    return wire.groupBy(batch_col).agg(
        F.max_by(F.col(f"{a}.sequenceId"), F.col(pos_col)).alias("sequence_id"))


def wire_batch_stats(wire: DataFrame, links: DataFrame, batch_col: str, a: str = "a") -> DataFrame:
    """Per batch: articles, parent lookups (first article of each feed id =
    miss, the rest = hits) and parents created."""
    per = wire.groupBy(batch_col).agg(
        F.count("*").alias("articles"),
        F.count_distinct(feed_key(a)).alias("misses"))
    created = (wire.select(batch_col, feed_key(a).alias("metabase_id"))
               .join(links.filter("created").select("metabase_id"), "metabase_id", "left_semi")
               .groupBy(batch_col).agg(F.count_distinct("metabase_id").alias("created")))
    return (per.join(created, batch_col, "left")
            .select(batch_col, "articles", (F.col("articles") - F.col("misses")).alias("hits"),
                    "misses", F.coalesce("created", F.lit(0)).alias("created")))
