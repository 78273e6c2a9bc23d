"""Batch jobs over a ``TableStore``, one per scheduled job of the reference.

Dimension tables (pubs, feeds, work, counts, cursors, categories, aliases,
pub redirects) are versioned snapshots; the fact tables (articles, rejects)
are append-only parts. A duplicate-publication merge does not rewrite
articles: it publishes an old -> new pub map that ``current_articles``
applies at read time (a join to one row per old id).

Part names must sort in time order (e.g. ``20240130T120000`` or a
zero-padded batch number); a replay with the same part name is harmless. The
feed and the newswire job may use one name: each adds its own suffix. Tables
that several jobs write are changed through ``TableStore.update``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsdesk import schema as S
from newsdesk.operators import articles as art
from newsdesk.operators import categories as cat
from newsdesk.operators import counts as cnt
from newsdesk.operators import feeds as fd
from newsdesk.operators import pubs as pb
from newsdesk.operators import tables as tb
from newsdesk.operators import work as wk
from newsdesk.store import PartTable, TableStore, newest_per_key, url_index

REDIRECTS = "pub_redirects"
REDIRECT_SCHEMA = "old_id string, new_id string"
#: kind 'part': key = part, id = the write that was counted; kind 'count':
#: key = type, id, n. One table, so that counts and cursor are one commit.
COUNT_STATE_SCHEMA = "kind string, key string, id string, n bigint"
FEED_QUEUE, FEED_QUEUE_SCHEMA = "feed_queue", "feed_id string, enqueued timestamp"
WIRE_CURSOR_SCHEMA = "sequence_id string"


def conform(df: DataFrame, schema) -> DataFrame:
    """Columns of ``schema`` in order: present ones cast, missing ones NULL."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in have
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def _articles(store: TableStore) -> PartTable:
    return PartTable(store, "articles", key="article_id")


def _rejects(store: TableStore) -> PartTable:
    return PartTable(store, "rejects")


def feed_part(part: str) -> str:
    """Part name of a batch of feed articles."""
    return f"{part}.feed"


def wire_part(part: str) -> str:
    """Part name of a newswire batch."""
    return f"{part}.wire"


def _save(store: TableStore, articles: DataFrame, part: str) -> None:
    """A part of the article table, then its urls."""
    table = _articles(store)
    table.append(conform(articles, S.ARTICLE), part)
    saved = table.rows(S.ARTICLE, {p: w for p, w in table.current().items() if p == table.part_value(part)})
    url_index(store).add(saved, part)


def current_articles(store: TableStore, exclude_part: str | None = None,
                     columns: list[str] | None = None) -> DataFrame:
    """All saved articles, newest part per id, pub ids through the merge map.
    The per-id dedupe is a shuffle of every id: readers that do not need
    exact rows use ``raw_articles``; readers that need few columns name them
    (the dedupe cannot prune inside its struct)."""
    if columns is not None and store.exists(REDIRECTS):
        columns = list(dict.fromkeys(list(columns) + ["pub_id"]))
    a = _articles(store).read(S.ARTICLE, exclude_part, columns)
    if store.exists(REDIRECTS):
        a = pb.pub_repoint(a, store.read(REDIRECTS))
    return a


def raw_articles(store: TableStore, exclude_part: str | None = None) -> DataFrame:
    """Union of the article parts without the per-id dedupe (a replayed id
    may appear twice), pub ids through the merge map. Enough for per-url
    min/max ids, the newest article per pub and the largest id, none of
    which a repeated (id, row) changes."""
    a = PartTable(store, "articles").read(S.ARTICLE, exclude_part).drop("part")
    if store.exists(REDIRECTS):
        a = pb.pub_repoint(a, store.read(REDIRECTS))
    return a


# ---------------------------------------------------------------- load
def prime(store: TableStore, legacy_path: str) -> None:
    """Load the legacy catalogue dump into the pub and feed tables."""
    from newsdesk.sources.files import read_legacy_pubs
    pubs, feeds = read_legacy_pubs(store.spark, legacy_path)
    store.write("pubs", conform(pubs, S.PUB))
    store.write("feeds", conform(feeds.withColumn("origin", F.lit("rss")), S.FEED))


def apply_cats(store: TableStore) -> None:
    """Publish the category alias table."""
    store.write("category_aliases", cat.alias_table(store.spark))


# ---------------------------------------------------------------- feed path
def enqueue_feeds(store: TableStore, now, limit: int = fd.DEFAULT_LIMIT,
                  threshold: int = wk.DEFAULT_THRESHOLD, work_threshold: int | None = None) -> DataFrame:
    """Due feeds with what a conditional poll sends (url, etag, modified:
    the one name the poll update writes), or none when the queues are too deep
    (one boolean each reaches the driver: the go / no-go).

    Two queues are looked at: the feeds that were enqueued and not polled yet
    (the topic this job writes to, table ``feed_queue``, with its own depth),
    and the entries in work. ``work_threshold`` is the latter's, if another.
    The feeds of a run enter the queue; their polls (``download_feed``) take
    them out."""
    feeds = store.read("feeds", S.FEED)
    cols = ["feed_id", "url", "etag", "modified"]
    queued = store.read(FEED_QUEUE, FEED_QUEUE_SCHEMA).select(F.lit(FEED_QUEUE).alias("topic"), F.lit("download").alias("channel"))
    topic = wk.topic_depth(queued, threshold)
    depth = wk.queue_depth(store.read("work", S.WORK), work_threshold or threshold)
    if not (wk.may_enqueue(topic).first().ok and wk.may_enqueue(depth).first().ok):
        return feeds.filter(F.lit(False)).select(*cols)      # no-go: no feeds this run
    due = fd.feeds_due(feeds, now, limit).select(*cols)
    store.update(FEED_QUEUE, lambda q: q.unionByName(
        due.select("feed_id", F.lit(now).cast("timestamp").alias("enqueued")).join(q, "feed_id", "left_anti")), FEED_QUEUE_SCHEMA)
    return due


def download_feed(store: TableStore, polls: DataFrame, now) -> DataFrame:
    """Apply poll results to the feed table and queue their new entries as
    work (insert-ignore on link and id). Returns the queued rows."""
    feeds = store.read("feeds", S.FEED)
    entries = fd.entry_ids(fd.entries_with_link(fd.feed_entries(polls)))
    rows = (entries.join(feeds.select("feed_id", "pub_id"), "feed_id", "left")
            .select("article_id", "feed_id", "pub_id", "link",
                    F.lit("download-entry").alias("stage"),
                    F.col("fetched_at").alias("started"), F.lit(now).cast("timestamp").alias("last_action"),
                    "title", "author", "published",
                    F.struct("fetched_at", "feed_id", "entry_pos").alias("order")))
    store.update("feeds", lambda t: fd.feed_poll_update(t, polls, now), S.FEED)
    inserted = []

    def queued(work: DataFrame) -> DataFrame:
        inserted.append(tb.insert_ignore(work, rows, ["link", "article_id"]).drop("order"))
        return work.unionByName(inserted[-1])

    store.update("work", queued, S.WORK)
    if store.exists(FEED_QUEUE):
        store.update(FEED_QUEUE, lambda q: tb.delete_by_key(q, polls.select("feed_id"), "feed_id"), FEED_QUEUE_SCHEMA)
    return inserted[-1]


def process_pages(store: TableStore, pages: DataFrame, part: str, now,
                  size_limit: int = art.SIZE_LIMIT) -> None:
    """Fetched pages -> saved articles (new part) + rejects (new part); their
    work rows leave the queue. What the feed entry said (title, author,
    published) comes from the work row where the fetch does not carry it, and
    a reject carries its work row. URLs are held against all history in the
    buckets of the url index that the batch touches."""
    from newsdesk.plans.rss import process_pages as stages
    part = feed_part(part)
    work = store.read("work", S.WORK)
    index = url_index(store)
    keep, rejects, cached = stages(
        conform(pages, S.PAGE_FETCH), store.read("pubs", S.PUB), lambda urls: index.stored(urls, exclude_part=part), size_limit,
        said=work.select("article_id", "title", "author", "published"))
    _save(store, keep.withColumn("added", F.lit(now).cast("timestamp")), part)
    # the work row of a reject is complete: its own values win over the page's
    own = [c for c in S.WORK.names if c in rejects.columns and c not in ("article_id", "link")]
    full = rejects.join(work.select("article_id", *[F.col(c).alias(f"_w_{c}") for c in S.WORK.names if c != "article_id"]), "article_id", "left")
    full = full.select("article_id", F.coalesce("link", "_w_link").alias("link"), "reason", F.lit(now).cast("timestamp").alias("added"),
                       *[F.coalesce(f"_w_{c}", c).alias(c) for c in own],
                       *[F.col(f"_w_{c}").alias(c) for c in S.WORK.names if c not in ("article_id", "link", *own)])
    _rejects(store).append(conform(full, S.REJECT), part)
    store.update("work", lambda t: tb.delete_by_key(t, pages.select("article_id"), "article_id"), S.WORK)
    cached.unpersist()


# ---------------------------------------------------------------- newswire
def metabase(store: TableStore, wire_rows: DataFrame, part: str, run_ts,
             is_lexisnexis: bool = False, xml_col: str | None = None) -> None:
    """Newswire batch (parsed rows with ``a``, ``seq`` and, where the source
    carries it, ``pos``) -> new parents, articles (new part) and the cursor:
    the sequence id of the batch's last article in document order. A batch
    without articles leaves the cursor."""
    from newsdesk.plans.wire import ingest_wire, position
    from newsdesk.operators.wire import wire_cursor
    new_pubs, new_feeds, arts, cached = ingest_wire(wire_rows, store.read("feeds", S.FEED), run_ts, is_lexisnexis,
                                                    xml_col=xml_col, batch_name=part)
    _save(store, arts, wire_part(part))

    def with_new(new: DataFrame, schema, key: str):
        # a replay, or another writer, may have added the same parents
        return lambda t: t.unionByName(conform(new, schema).join(t.select(key), key, "left_anti").select(*t.columns))

    store.update("pubs", with_new(new_pubs, S.PUB, "pub_id"), S.PUB)
    store.update("feeds", with_new(new_feeds, S.FEED, "feed_id"), S.FEED)
    last = wire_cursor(cached.withColumn("_b", F.lit(1)), "_b", position(cached)).select("sequence_id").first()
    if last is not None:
        store.write("wire_cursor", store.spark.createDataFrame([(last.sequence_id,)], WIRE_CURSOR_SCHEMA))
    cached.unpersist()


def metabase_files(store: TableStore, path: str, part: str, run_ts, is_lexisnexis: bool = False) -> None:
    """Newswire response files -> ``metabase``. A response with status FAILURE
    stops the job before anything is written; records that can't be read go to
    the rejects with their text."""
    from pyspark import StorageLevel
    from newsdesk.plans.wire import wire_rejects, wire_rows_from_files
    from newsdesk.sources.wire import check_status, read_wire
    check_status(store.spark, path)
    records = read_wire(store.spark, path, with_position=True).persist(StorageLevel.MEMORY_AND_DISK)
    metabase(store, wire_rows_from_files(records), part, run_ts, is_lexisnexis)
    bad = wire_rejects(records).select(F.col("record").alias("data"), "reason", F.lit("metabase").alias("stage"),
                                       F.lit(run_ts).cast("timestamp").alias("added"))
    _rejects(store).append(conform(bad, S.REJECT), wire_part(part))
    records.unpersist()


# ---------------------------------------------------------------- upkeep
def _publish_counts(store: TableStore, state: DataFrame) -> None:
    """The table ``counts``: what was counted, pubs through the merge map."""
    c = state.filter("kind = 'count'").select(F.col("key").alias("type"), "id", "n")
    if store.exists(REDIRECTS):
        pubs = pb.pub_repoint(c.filter("type = 'pub'").withColumnRenamed("id", "pub_id"), store.read(REDIRECTS))
        c = c.filter("type <> 'pub'").unionByName(pubs.withColumnRenamed("pub_id", "id"))
    store.write("counts", c.groupBy("type", "id").agg(F.sum("n").alias("n")))


def recount_articles(store: TableStore) -> bool:
    """Bring the stored counts up to the article table; False when nothing
    was written since.

    The cursor is the set of (part, write) that the counts hold, not an article
    id or the name of the last part: a late part has a name before others, and a
    part may be written again. Only ids of new, rewritten or removed parts can
    count differently. What they counted before (the newest of the counted
    writes) is taken out, what they count now is added. Parts of other times are
    pruned by the range of these ids, which begin with their time."""
    table = _articles(store)
    now = table.current()
    state = store.read("count_state", COUNT_STATE_SCHEMA)
    was = {r.key: r.id for r in state.filter("kind = 'part'").collect()}          # one row for each part
    have = table.writes()
    lost = any(w not in have.get(p, []) for p, w in was.items())                   # vacuumed: count anew
    if lost:
        was, state = {}, state.filter(F.lit(False))
    changed = {p for p in {*now, *was} if now.get(p) != was.get(p)}
    if not changed:
        return False
    narrow = ["article_id", "pub_id", "feed_id", "part"]
    before, after = table.rows(S.ARTICLE, was).select(*narrow), table.rows(S.ARTICLE, now).select(*narrow)

    def ids(writes: dict[str, str]) -> DataFrame:
        return table.rows(S.ARTICLE, {p: w for p, w in writes.items() if p in changed}).select("article_id")

    touched = ids(was).union(ids(now)).distinct().persist()
    span = touched.agg(F.min("article_id").alias("low"), F.max("article_id").alias("high")).first()

    def counted(rows: DataFrame, sign: int) -> DataFrame:
        near = rows.filter(F.col("article_id").between(span.low, span.high)).join(touched, "article_id", "left_semi")
        return cnt.article_counts(newest_per_key(near, "article_id")).withColumn("n", sign * F.col("n"))

    old = state.filter("kind = 'count'").select(F.col("key").alias("type"), "id", "n")
    counts = (old.unionByName(counted(before, -1)).unionByName(counted(after, 1))
              .groupBy("type", "id").agg(F.sum("n").alias("n")).filter("n <> 0"))
    parts = store.spark.createDataFrame([("part", p, w, None) for p, w in now.items()], COUNT_STATE_SCHEMA)
    store.write("count_state", counts.select(F.lit("count").alias("kind"), F.col("type").alias("key"), "id", "n").unionByName(parts))
    _publish_counts(store, store.read("count_state"))
    touched.unpersist()
    return True


def vacuum_articles(store: TableStore) -> list[str]:
    """Remove article writes that a newer write of their part replaced, but
    not those that the counts still hold."""
    state = store.read("count_state", COUNT_STATE_SCHEMA)
    return _articles(store).vacuum({r.key: r.id for r in state.filter("kind = 'part'").collect()})


def merge_publications(store: TableStore) -> int:
    """Fold duplicate pubs into their survivor: pubs lose the duplicates,
    feeds are repointed, articles get the map (composed with earlier ones), and
    so do the stored counts. Returns the version of the pub table written."""
    m = pb.duplicate_pubs(store.read("pubs", S.PUB)).select("old_id", "new_id")

    def composed(old: DataFrame) -> DataFrame:
        # a -> b from before and b -> c now make a -> c
        chained = (old.alias("o").join(m.alias("m"), F.col("o.new_id") == F.col("m.old_id"), "left")
                   .select(F.col("o.old_id"), F.coalesce(F.col("m.new_id"), F.col("o.new_id")).alias("new_id")))
        return chained.unionByName(m).groupBy("old_id").agg(F.min("new_id").alias("new_id"))

    store.update(REDIRECTS, composed, REDIRECT_SCHEMA)
    store.update("feeds", lambda t: pb.pub_repoint(t, m), S.FEED)
    v = store.update("pubs", lambda t: tb.delete_by_key(t, m.select(F.col("old_id").alias("pub_id")), "pub_id"), S.PUB)
    if store.exists("count_state"):
        _publish_counts(store, store.read("count_state"))
    return v


def unique_categories(store: TableStore, now) -> None:
    pubs = store.read("pubs", S.PUB)
    store.update("categories", lambda have: have.unionByName(
        cat.unique_categories(pubs, have, now).select(*S.CATEGORY_UNIQUE.names)), S.CATEGORY_UNIQUE)


def pub_cats(store: TableStore) -> None:
    """Back-fill categories, country and genre of pubs without categories
    from their newest newswire article's XML."""
    from newsdesk.sources.wire import parse_wire
    spark = store.spark
    articles = raw_articles(store)
    store.update("pubs", lambda t: pb.pub_category_backfill(t, articles, lambda c: parse_wire(spark, F.decode(c, "UTF-8"), mapped=True)), S.PUB)


def pub_export(store: TableStore, path: str) -> None:
    from newsdesk.sinks import export_pubs_csv
    export_pubs_csv(store.read("pubs", S.PUB), path)
