"""Structured Streaming versions of the pipeline stages.

Sinks are replay-safe: each micro-batch writes its own ``batch=<id>``
folder with overwrite, so a batch re-run after a failure replaces its own
output and nothing else; the checkpoint is the only cursor. What a batch must
know of earlier ones is a table in hash buckets (``store.KeyIndex``), not state
that grows.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from newsdesk import schema as S
from newsdesk.operators import articles as art
from newsdesk.operators import counts, feeds
from newsdesk.operators.tables import dedupe_first
from newsdesk.sources.wire import read_wire
from newsdesk.store import KeyIndex, Scratch, TableStore


def _batch_dir(table: str, batch_id: int) -> str:
    return os.path.join(table, f"batch={batch_id:012d}")


def _has_data(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds at least one ``batch=`` folder (Hadoop file
    system of the path, so shared storage works)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and any(st.getPath().getName().startswith("batch=") for st in fs.listStatus(p))


def _table(table):
    """A dimension of a stream: a function is called in each micro-batch, so
    that the batch sees the newest snapshot (``lambda: store.read("pubs")``); a
    DataFrame stays as it was when the stream began."""
    return table() if callable(table) else table


def _index(spark: SparkSession, table: str, suffix: str, key: str, columns: list[str]) -> KeyIndex:
    """The index next to a stream's output table."""
    return KeyIndex(TableStore(spark, os.path.dirname(table)), os.path.basename(table) + suffix, key, columns)


def _part(batch_id: int) -> str:
    return f"{batch_id:012d}"


def _adaptive(sink):
    """``sink`` with adaptive execution on for what it runs: a stream's session
    has it off, so each exchange of a micro-batch would be read by all shuffle
    partitions, and no join would turn into a broadcast. The batch's own plan
    is already fixed then."""
    def run(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        was = conf.get("spark.sql.adaptive.enabled")
        conf.set("spark.sql.adaptive.enabled", "true")
        try:
            sink(batch, batch_id)
        finally:
            conf.set("spark.sql.adaptive.enabled", was)
    return run


def stream_feed_entries(spark: SparkSession, polls_dir: str, out_table: str, checkpoint: str,
                        seen=None, trigger_once: bool = True,
                        max_files: int | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Landed poll results -> entries of readable polls -> links never seen
    before, over all history.

    The history is the table of links itself, in hash buckets (``KeyIndex``): a
    micro-batch is held against the buckets it touches. The stream keeps no
    state that grows, a late copy of any age is recognised, and a restarted
    query (or a batch that runs again) finds the same history. Of the copies of
    a new link in a micro-batch the first by (fetched_at, feed, place in the
    poll) is kept. ``seen`` (a DataFrame with ``link``, or a function that reads
    it anew, e.g. the links still in the work table) is an extra anti join."""
    r = spark.readStream.schema(_poll_schema())
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    polls = r.format(fmt).load(polls_dir)        # landed polls: parquet or JSON lines
    entries = (feeds.entries_with_link(feeds.feed_entries(polls))
               .select("feed_id", "fetched_at", "entry_pos", "link", "author", "title", "published"))
    index = _index(spark, out_table, "_links", "link", ["article_id"])

    def sink(batch: DataFrame, batch_id: int) -> None:
        first = dedupe_first(batch, "link", ["fetched_at", "feed_id", "entry_pos"]).persist(StorageLevel.MEMORY_AND_DISK)
        fresh = first.join(index.stored(first, exclude_part=_part(batch_id)).select("link"), "link", "left_anti")
        if seen is not None:
            fresh = fresh.join(_table(seen).select("link"), "link", "left_anti")
        feeds.entry_ids(fresh).write.mode("overwrite").parquet(_batch_dir(out_table, batch_id))
        index.add(spark.read.parquet(_batch_dir(out_table, batch_id)), _part(batch_id))
        first.unpersist()

    w = entries.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="30 seconds")
    return w.start()


def _poll_schema():
    from pyspark.sql import types as T
    return T.StructType(S.FEED_POLL.fields + [T.StructField("event_id", T.LongType())])


def stream_article_counts(spark: SparkSession, articles_dir: str, out_table: str, checkpoint: str,
                          schema=None, max_files: int | None = None,
                          trigger_once: bool = True) -> StreamingQuery:
    """Running counts per pub and feed. Each batch writes by how much it
    changed the keys, and the current count of a key is the sum
    (``current_counts``). An id that is saved again counts once, for the pub and
    feed it was saved with last: what it counted before, as the index of ids in
    hash buckets knows, is taken out. Of the rows of an id in one batch the
    greatest (pub, feed) counts."""
    r = spark.readStream.schema(schema or S.ARTICLE)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    a = r.parquet(articles_dir).select("article_id", "pub_id", "feed_id")
    index = _index(spark, out_table, "_ids", "article_id", ["pub_id", "feed_id"])

    def sink(batch: DataFrame, batch_id: int) -> None:
        # written, not cached: what reads it has as many tasks as it has bytes
        kept = Scratch(batch.groupBy("article_id").agg(F.max(F.struct("pub_id", "feed_id")).alias("m")).select("article_id", "m.*"))
        new = kept.rows
        old = index.newest(new, exclude_part=_part(batch_id))
        delta = (counts.article_counts(new).unionByName(counts.article_counts(old).withColumn("n", -F.col("n")))
                 .groupBy("type", "id").agg(F.sum("n").alias("n")).filter("n <> 0"))
        delta.write.mode("overwrite").parquet(_batch_dir(out_table, batch_id))
        index.add(new, _part(batch_id))
        kept.remove()

    w = a.writeStream.foreachBatch(_adaptive(sink)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="5 minutes")
    return w.start()


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _base_version(spark: SparkSession, table: str) -> int | None:
    fs, p = _fs(spark, table + "_base")
    if not fs.exists(p):
        return None
    vs = [int(st.getPath().getName()[2:]) for st in fs.listStatus(p)
          if st.getPath().getName().startswith("v=")
          and fs.exists(st.getPath().suffix("/_SUCCESS"))]
    return max(vs) if vs else None


def current_counts(spark: SparkSession, table: str) -> DataFrame:
    """Current count per key: the compacted base (if any) plus what the batches
    after it changed."""
    parts = []
    v = _base_version(spark, table)
    if v is not None:
        parts.append(spark.read.parquet(f"{table}_base/v={v:012d}").withColumn("batch", F.lit(v)))
    if _has_data(spark, table):
        b = spark.read.parquet(table)
        parts.append(b.filter(F.col("batch") > v) if v is not None else b)
    if not parts:
        return spark.createDataFrame([], "type string, id string, n bigint")
    t = parts[0]
    for x in parts[1:]:
        t = t.unionByName(x)
    return t.groupBy("type", "id").agg(F.sum("n").alias("n")).filter("n <> 0")


def compact_counts(spark: SparkSession, table: str) -> int | None:
    """Fold every batch folder into a new base snapshot and drop the folded
    batches, so reads stop growing with the number of micro-batches. Safe to
    run next to the stream: batches written later have larger ids and stay.
    Returns the base version (the largest folded batch id)."""
    if not _has_data(spark, table):
        return _base_version(spark, table)
    top = spark.read.parquet(table).agg(F.max("batch")).first()[0]   # one value
    # the new base holds the state as of batch `top`: batches written after
    # it (a running stream) are left for readers to apply on top
    v = _base_version(spark, table)
    parts = []
    if v is not None:
        parts.append(spark.read.parquet(f"{table}_base/v={v:012d}").withColumn("batch", F.lit(v)))
    b = spark.read.parquet(table)
    parts.append(b.filter((F.col("batch") <= top) & ((F.col("batch") > v) if v is not None else F.lit(True))))
    t = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    base = t.groupBy("type", "id").agg(F.sum("n").alias("n")).filter("n <> 0")
    base.write.mode("overwrite").parquet(f"{table}_base/v={top:012d}")
    fs, p = _fs(spark, table)
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("batch=") and int(name.split("=", 1)[1]) <= top:
            fs.delete(st.getPath(), True)
    return top


def stream_wire(spark: SparkSession, wire_dir: str, feeds_table, out_table: str,
                checkpoint: str, run_ts, is_lexisnexis: bool = False, max_files: int = 1,
                trigger_once: bool = True, max_file_age: str | None = None) -> StreamingQuery:
    """Newswire files in arrival order (``maxFilesPerTrigger``), mapped to
    articles with their parent pub/feed (``plans.wire.ingest_wire``).
    ``feeds_table`` is a DataFrame, or a function that reads the newest snapshot
    in each micro-batch. ``cursor`` gets each batch's last sequence id in
    document order. New parents of a batch are written next to the articles, and later batches
    see them as known parents. ``run_ts=None`` (continuous runs) takes each
    micro-batch's time from its newest harvest date. ``max_file_age`` (e.g.
    "48h") ignores older files, the cursor expiry of the reference; a fresh
    checkpoint restarts the cursor."""
    from newsdesk.operators.wire import wire_cursor
    from newsdesk.plans.wire import ingest_wire, wire_rejects, wire_rows_from_files
    src = (spark.readStream.format("xml").option("rowTag", "article")
           .option("maxFilesPerTrigger", max_files)
           .schema(read_wire(spark, wire_dir, with_file=False).schema))
    if max_file_age:
        src = src.option("maxFileAge", max_file_age)
    src = src.load(wire_dir).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        pos = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"), F.monotonically_increasing_id().alias("row"))
        # records and rejects from one parse; places as the scan had them
        batch = batch.withColumn("pos", pos).drop("_file", "_block").persist(StorageLevel.MEMORY_AND_DISK)
        rows = wire_rows_from_files(batch)          # a projection of what is kept
        ts = run_ts
        if ts is None:
            # the batch's own clock: its newest harvest date (one value; the
            # same on a replay of the batch, so ids repeat)
            from newsdesk.functions.dates import parse_rfc3339_strict
            ts = rows.agg(F.max(parse_rfc3339_strict(F.col("a.harvestDate")))).first()[0]
            ts = ts or "1970-01-01 00:00:00"
        known = _table(feeds_table).select("feed_id", "pub_id", "metabase_id")
        ptable = os.path.join(out_table, "_parents_feeds")
        if _has_data(spark, ptable):
            prior = (spark.read.schema("feed_id string, pub_id string, metabase_id bigint, batch long").parquet(ptable)
                     .filter(F.col("batch") < batch_id))
            known = known.unionByName(prior.drop("batch"))
        new_pubs, new_feeds, arts, parents = ingest_wire(rows, known, ts, is_lexisnexis,
                                                         batch_name=f"batch-{batch_id}", kept=True)
        new_feeds.write.mode("overwrite").parquet(_batch_dir(ptable, batch_id))
        new_pubs.write.mode("overwrite").parquet(_batch_dir(os.path.join(out_table, "_parents_pubs"), batch_id))
        arts.write.mode("overwrite").parquet(_batch_dir(os.path.join(out_table, "articles"), batch_id))
        wire_cursor(rows.withColumn("_b", F.lit(batch_id)), "_b", "pos").select("sequence_id").write.mode("overwrite").parquet(
            _batch_dir(os.path.join(out_table, "cursor"), batch_id))
        wire_rejects(batch).write.mode("overwrite").parquet(_batch_dir(os.path.join(out_table, "rejects"), batch_id))
        parents.unpersist()
        batch.unpersist()

    w = src.writeStream.foreachBatch(_adaptive(sink)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="30 seconds")
    return w.start()


def stream_articles(spark: SparkSession, pages_dir: str, pubs_table, store_table: str,
                    checkpoint: str, size_limit: int = art.SIZE_LIMIT, max_files: int | None = None,
                    trigger_once: bool = True, url_history: str = "store",
                    fmt: str = "parquet") -> StreamingQuery:
    """Fetched pages -> checks -> final URL -> extraction -> XPath rules ->
    merge -> URL dedupe -> save; rejects go to ``<store>_rejects``. One
    streaming query; the stages are the batch functions of ``plans.rss``.

    ``pubs_table`` is a DataFrame, or a function that reads the newest snapshot
    in each micro-batch: a publication created while the stream runs is found.

    ``url_history`` picks how a url already saved is recognised:
    ``"store"`` (exact, duplicates become rejects) checks each micro-batch
    against the index of saved urls, in the buckets that the batch touches;
    ``"state"`` keeps the urls in RocksDB keyed state and drops later copies
    before extraction (no scan, and duplicates never reach the UDFs; they leave
    no reject row), with the publications of the stream's start; later ones are
    held against the index. Both save the same urls: only a page that passes the
    checks and has a publication claims its url. A reject is a work row."""
    from newsdesk.plans.jobs import conform
    from newsdesk.plans.rss import process_pages
    r = spark.readStream.schema(S.PAGE_FETCH)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    pages = r.format(fmt).load(pages_dir)
    if url_history == "state":
        # only a page that will be saved claims its url: a refused one or one
        # without a publication has a claim of its own and goes on to its reject
        known = _table(pubs_table).select("pub_id", F.lit(True).alias("_known")).dropDuplicates(["pub_id"])
        p = art.has_html(art.page_validate(art.resolve_links(pages), size_limit)).join(known, "pub_id", "left")
        saved = F.col("reject_reason").isNull() & F.col("_known").isNotNull() & F.col("url").isNotNull()
        pages = (p.withColumn("claim", F.when(saved, F.struct(F.lit("url").alias("kind"), F.col("url").alias("of")))
                              .otherwise(F.struct(F.lit("page").alias("kind"), F.col("article_id").alias("of"))))
                 .dropDuplicates(["claim"]).select(*S.PAGE_FETCH.names))
    elif url_history != "store":
        raise ValueError(f"url_history must be 'store' or 'state', not {url_history!r}")
    index = _index(spark, store_table, "_urls", "url", ["article_id"])

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # two outputs from one read
        check = url_history == "store" or callable(pubs_table)
        if check and batch_id and not index.parts.parts() and _has_data(spark, store_table):   # a table from before the index
            index.add(spark.read.parquet(store_table).filter(F.col("batch") < batch_id), "0")
        none = spark.createDataFrame([], "article_id string, url string")
        keep, rejects, cached = process_pages(
            batch, _table(pubs_table), (lambda urls: index.stored(urls, exclude_part=_part(batch_id))) if check else none, size_limit)
        keep.write.mode("overwrite").parquet(_batch_dir(store_table, batch_id))
        if check:
            index.add(spark.read.parquet(_batch_dir(store_table, batch_id)), _part(batch_id))
        whole = conform(rejects.withColumn("stage", F.lit("download-entry")).withColumn("added", F.col("started")), S.REJECT)
        whole.write.mode("overwrite").parquet(_batch_dir(store_table + "_rejects", batch_id))
        cached.unpersist()
        batch.unpersist()

    w = pages.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="10 seconds")
    return w.start()


def stream_wire_archive(spark: SparkSession, wire_dir: str, archive_path: str, checkpoint: str,
                        trigger_once: bool = True) -> StreamingQuery:
    """Keep a copy of every raw newswire response as it arrives, partitioned
    by the file's modification date (the file's own time: a replay files it
    under the same date). A response is one API page (at most 500 articles),
    so one whole file per row is a bounded unit."""
    from newsdesk.sources.wire import archive_wire
    raw = (spark.readStream.format("text").option("wholetext", True).load(wire_dir)
           .select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("source_file"),
                   F.col("_metadata.file_modification_time").alias("fetched_at")))

    def sink(batch: DataFrame, batch_id: int) -> None:
        archive_wire(batch, os.path.join(archive_path, f"batch={batch_id:012d}"), mode="overwrite")

    w = raw.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="30 seconds")
    return w.start()
