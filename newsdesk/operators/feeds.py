"""Feed selection, poll results and feed entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsdesk.operators.tables import dedupe_first
from newsdesk.functions.ids import make_id

from newsdesk.fixed import DUE_FEEDS_LIMIT as DEFAULT_LIMIT, MISSING_STATUS, REPOLL, SKIP_STATUSES


def _ts(now):
    """A time parameter: a Column as is, anything else as a timestamp literal."""
    return now if isinstance(now, Column) else F.lit(now).cast("timestamp")


def feeds_due_filter(feeds: DataFrame, now) -> DataFrame:
    """bozo 0 (a feed that never reported bozo counts as 0), no newswire
    id, and next download unset or not after ``now``."""
    nd = F.col("next_download")
    return feeds.filter((F.coalesce(F.col("bozo"), F.lit(0)) == 0)
                        & F.col("metabase_id").isNull()
                        & (nd.isNull() | (nd <= _ts(now))))


def feeds_due(feeds: DataFrame, now, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Top ``limit`` due feeds, next download ascending with unset first.
    Sort + limit plans as TakeOrderedAndProject: per-partition top-k, then
    one merge of k rows per partition."""
    return (feeds_due_filter(feeds, now)
            .orderBy(F.col("next_download").asc_nulls_first(), F.col("feed_id"))
            .limit(limit))


def feeds_not_due(feeds: DataFrame, now) -> DataFrame:
    """The saved "next download" view: no newswire id and next download
    unset or at/after ``now``."""
    nd = F.col("next_download")
    return feeds.filter(F.col("metabase_id").isNull() & (nd.isNull() | (nd >= _ts(now))))


def next_download(bozo, now):
    """Next poll one hour after ``now`` when the poll parsed cleanly (bozo 0),
    else NULL (the feed stays out of the due list)."""
    b = F.col(bozo) if isinstance(bozo, str) else bozo
    return F.when(b == 0, _ts(now) + F.expr(REPOLL))


def moved_url(status, href, url, original_url=None) -> tuple[Column, Column]:
    """(url, original_url) after a poll: on 301 the final href and the url it
    replaces; else the url and what was there (none by default)."""
    moved = F.coalesce(status == 301, F.lit(False))
    before = F.lit(None).cast("string") if original_url is None else original_url
    return F.when(moved, href).otherwise(url), F.when(moved, url).otherwise(before)


def latest_poll(polls: DataFrame) -> DataFrame:
    """Newest poll per feed (fetched_at, then etag as tie-break), as a
    partial aggregate."""
    cols = [c for c in polls.columns if c not in ("feed_id", "entries")]
    return dedupe_first(
        polls.select("feed_id", *cols,
                     (-F.unix_micros("fetched_at")).alias("_neg")),
        "feed_id", ["_neg"] + [c for c in ("event_id",) if c in cols]).drop("_neg")


def _poll_summary(polls: DataFrame) -> DataFrame:
    """Per feed: the latest poll's values, the last ``updated`` and the last
    two moves (301), in the order of ``latest_poll``."""
    tie = -F.col("event_id") if "event_id" in polls.columns else F.lit(0)
    at = F.struct(F.unix_micros("fetched_at").alias("t"), tie.alias("k"))
    q = polls.select("feed_id", at.alias("_at"), "bozo", "etag", "modified", "status", "updated", "href")
    vals = F.struct("bozo", "etag", "modified", "status")
    move = F.when(F.col("status") == 301, F.struct("_at", "href"))
    per = q.groupBy("feed_id").agg(
        F.max(F.struct("_at", vals.alias("v"))).alias("_last"),
        F.max(F.when(F.col("updated").isNotNull(), F.struct("_at", "updated"))).alias("_upd"),
        F.max(move).alias("_p_move"))
    before = (q.filter(F.col("status") == 301).join(
                  per.filter("_p_move IS NOT NULL").select("feed_id", F.col("_p_move._at").alias("_m")), "feed_id")
              .filter(F.col("_at") < F.col("_m"))
              .groupBy("feed_id").agg(F.max(F.struct("_at", "href")).alias("_p_before")))
    return per.join(before, "feed_id", "left").select(
        "feed_id", *[F.col(f"_last.v.{c}").alias(f"_p_{c}") for c in ("bozo", "etag", "modified", "status")],
        F.col("_upd.updated").alias("_p_updated"), "_p_move", "_p_before", F.lit(True).alias("_hit"))


def feed_poll_update(feeds: DataFrame, polls: DataFrame, now) -> DataFrame:
    """The feed table after all polls of a batch, as if applied one by one:
    bozo, etag, modified, status (missing = 500) and last/next download of the
    feed's latest poll; the last ``updated`` that any poll had; the href of
    its last 301 as url, with the url before that move (an earlier 301 of the
    batch, else the table's) as original_url.

    One partial aggregate of the polls per feed, joined to the feed table; the
    aggregate is already hash-partitioned on feed_id, so only the feed side is
    shuffled for the join. It keeps the two last moves of a feed, no lists."""
    p = _poll_summary(polls)
    j = feeds.join(p, "feed_id", "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    had = F.col("original_url") if "original_url" in feeds.columns else F.lit(None).cast("string")
    moved = F.col("_p_move").isNotNull()
    url = F.when(moved, F.col("_p_move.href")).otherwise(F.col("url"))
    original = (F.when(F.col("_p_before").isNotNull(), F.col("_p_before.href"))
                 .when(moved, F.col("url")).otherwise(had))
    new = {
        "bozo": F.col("_p_bozo"), "etag": F.col("_p_etag"), "modified": F.col("_p_modified"),
        "status": F.coalesce(F.col("_p_status"), F.lit(MISSING_STATUS)),
        "last_download": _ts(now),
        "next_download": next_download("_p_bozo", now),
    }
    out = []
    for c in feeds.columns:
        if c in new:
            out.append(F.when(hit, new[c]).otherwise(F.col(c)).alias(c))
        elif c == "updated":
            out.append(F.when(hit & F.col("_p_updated").isNotNull(), F.col("_p_updated"))
                        .otherwise(F.col(c)).alias(c))
        elif c == "url":
            out.append(url.alias(c))
        elif c == "original_url":
            out.append(original.alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def fetch_status_filter(polls: DataFrame) -> DataFrame:
    """Polls whose entries are read: status not 304/410/500 (missing = 500)."""
    return polls.filter(~F.coalesce(F.col("status"), F.lit(MISSING_STATUS)).isin(SKIP_STATUSES))


def feed_entries(polls: DataFrame) -> DataFrame:
    """One row per entry of the polls that are read."""
    keep = [c for c in polls.columns if c != "entries"]
    return (fetch_status_filter(polls)
            .select(*keep, F.posexplode("entries").alias("entry_pos", "e"))
            .select(*keep, "entry_pos", "e.link", "e.author", "e.title", "e.published"))


def entries_with_link(entries: DataFrame) -> DataFrame:
    return entries.filter(F.col("link").isNotNull())


def entry_ids(entries: DataFrame) -> DataFrame:
    """Deterministic article ids for new entries (time of poll + link)."""
    return entries.withColumn("article_id", make_id(F.col("fetched_at"), F.col("feed_id"), F.col("link")))


def entry_dedupe(entries: DataFrame, seen: DataFrame | None = None, key: str = "link",
                 order=("fetched_at", "feed_id", "entry_pos")) -> DataFrame:
    """New links only: first occurrence in the batch (by ``order``), minus
    links already in ``seen``. Full links are compared (no length cut)."""
    order = [c for c in order if c in entries.columns]
    first = dedupe_first(entries_with_link(entries), key, order or [key])
    if seen is not None:
        first = first.join(seen.select(key).distinct(), key, "left_anti")
    return first
