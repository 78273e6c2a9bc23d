"""Catalogue queries (the admin API's reads) as table functions.

Each ends in a limit (a page of results), so a sort over the whole table is
a per-partition top-k followed by one small merge.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F


from newsdesk.fixed import EXPORT_DATE_FORMAT, EXPORT_HEADER
from newsdesk.fixed import PAGE_LIMIT as DEFAULT_LIMIT, PAGE_LIMIT_MAX as MAX_LIMIT
SORTABLE = {"name", "pub_id", "country", "num_articles", "num_feeds", "num_readers", "added", "homepage"}


def _visible(df: DataFrame) -> DataFrame:
    return df.filter(~F.coalesce(F.col("deleted"), F.lit(False)))


def _limit(limit) -> int:
    try:
        i = int(limit)
    except (TypeError, ValueError):
        return DEFAULT_LIMIT
    return i if 0 < i <= MAX_LIMIT else DEFAULT_LIMIT


def _offset(offset) -> int:
    try:
        i = int(offset)
    except (TypeError, ValueError):
        return 0
    return i if i > 0 else 0


def search_filter(pubs: DataFrame, query: str | None) -> DataFrame:
    """Not deleted; a query that is an id matches the id, any other query is
    a case-insensitive regular expression on the name."""
    p = _visible(pubs)
    if not query:
        return p
    if re.fullmatch(r"[0-9a-fA-F]{24}", query):
        return p.filter(F.col("pub_id") == query.lower())
    return p.filter(F.col("name").rlike("(?i)" + query))


def search_pubs(pubs: DataFrame, query: str | None = None, sort: str = "name",
                limit=DEFAULT_LIMIT, offset=0) -> DataFrame:
    """One page of pubs. ``sort`` is a column name, ``-col`` for descending;
    the id breaks ties so pages are stable."""
    desc = sort.startswith("-")
    col = sort.lstrip("-") or "name"
    if col not in SORTABLE:
        col = "name"
    key = F.col(col).desc() if desc else F.col(col).asc()
    return (search_filter(pubs, query).orderBy(key, F.col("pub_id"))
            .offset(_offset(offset)).limit(_limit(limit)))


def search_pubs_total(pubs: DataFrame, query: str | None = None, limit=DEFAULT_LIMIT) -> DataFrame:
    """(total, pages) with pages = ceil(total / limit)."""
    lim = _limit(limit)
    return (search_filter(pubs, query).agg(F.count("*").alias("total"))
            .withColumn("pages", F.ceil(F.col("total") / F.lit(lim)).cast("bigint")))


def page_links(totals: DataFrame, limit=DEFAULT_LIMIT, offset=0) -> DataFrame:
    """first / prev / next / last offsets (NULL when that link is absent;
    no links at all for a single page)."""
    lim, off = _limit(limit), _offset(offset)
    t, pages = F.col("total"), F.col("pages")
    multi = pages > 1
    return totals.select(
        "total", "pages",
        F.when(multi & F.lit(off > 0), F.lit(0)).cast("bigint").alias("first"),
        F.when(multi & F.lit(off > 0), F.lit(off - lim)).cast("bigint").alias("prev"),
        F.when(multi & (F.lit(off + lim) < t), F.lit(off + lim)).cast("bigint").alias("next"),
        F.when(multi & (F.lit(off + lim) < t), (pages - 1) * lim).cast("bigint").alias("last"))


def pub_feeds(feeds: DataFrame, pub_id: str | None = None, limit: int = DEFAULT_LIMIT) -> DataFrame:
    f = _visible(feeds)
    if pub_id is not None:
        f = f.filter(F.col("pub_id") == pub_id)
    return f.orderBy("url", "feed_id").limit(limit)


def pub_by_id(pubs: DataFrame, pub_id: str) -> DataFrame:
    return pubs.filter(F.col("pub_id") == pub_id)


def feed_by_id(feeds: DataFrame, feed_id: str) -> DataFrame:
    return feeds.filter(F.col("feed_id") == feed_id)


def latest_articles(articles: DataFrame, pub_id: str | None = None, feed_id: str | None = None,
                    limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Newest ``limit`` articles (id descending) of a pub and/or feed."""
    a = articles
    if pub_id is not None:
        a = a.filter(F.col("pub_id") == pub_id)
    if feed_id is not None:
        a = a.filter(F.col("feed_id") == feed_id)
    return a.orderBy(F.col("article_id").desc()).limit(limit)


def date_label(c, soon: bool = False):
    """Display label of a feed date: "Never" for no last download, "Soon"
    for no next download."""
    return F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("Soon" if soon else "Never"))


def pub_overview(pubs: DataFrame, feeds: DataFrame, articles: DataFrame, pub_id: str,
                 limit: int = DEFAULT_LIMIT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The pub, its feeds (with date labels and a newswire flag) and its
    newest articles, as three frames (no collect_list of unbounded groups)."""
    pub = pub_by_id(pubs, pub_id)
    f = pub_feeds(feeds, pub_id, limit).select(
        "feed_id", "url", "num_articles",
        date_label(F.col("last_download")).alias("last_download"),
        date_label(F.col("next_download"), soon=True).alias("next_download"),
        (F.coalesce(F.col("metabase_id"), F.lit(0)) > 0).alias("is_newswire"))
    return pub, f, latest_articles(articles, pub_id=pub_id, limit=limit)


def export_rows(pubs: DataFrame) -> DataFrame:
    """Rows of the pub CSV export: ID, Pub Name, Homepage, Added (MM/dd/yyyy)."""
    cols = [F.col("pub_id"), F.col("name"), F.col("homepage"), F.date_format("added", EXPORT_DATE_FORMAT)]
    return pubs.select(*[c.alias(h) for c, h in zip(cols, EXPORT_HEADER)])
