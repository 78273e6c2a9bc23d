"""Jobs and streams keep what a batch brings: every poll, entry fields, late ids, whole XML, good fetches."""

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from newsdesk import schema as S
from newsdesk.operators import counts, feeds, tables
from newsdesk.plans import jobs
from newsdesk.plans.wire import wire_rejects
from newsdesk.session import checkpoint_dir
from newsdesk.sources import driver_tables
from newsdesk.sources.wire import archive_wire, read_wire
from newsdesk.store import TableStore
from newsdesk.streaming import jobs as streams
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def _base(spark) -> str:
    return checkpoint_dir(spark, "tests", uuid.uuid4().hex)


def _row(schema, **values):
    return tuple(values.get(n) for n in schema.names)


def _poll(feed, hour, status, href, updated=None, entries=()):
    return (feed, dt.datetime(2024, 1, 30, hour), status, 0, href, None, None, updated, list(entries))


def test_every_poll_of_a_batch_counts(spark):
    table = spark.createDataFrame([_row(S.FEED, feed_id=f, url=f"http://{f}/0") for f in "abcd"], S.FEED)
    when = dt.datetime(2024, 1, 29)
    polls = spark.createDataFrame([
        _poll("a", 1, 301, "http://a/1", when), _poll("a", 2, 200, "http://a/1"),     # move, then a plain poll
        _poll("b", 1, 301, "http://b/1"), _poll("b", 2, 301, "http://b/2"),           # two moves
        _poll("c", 1, 200, "http://c/9")], S.FEED_POLL)                              # no move
    out = {r.feed_id: r for r in feeds.feed_poll_update(table, polls, "2024-01-30 12:00:00").collect()}
    assert (out["a"].url, out["a"].original_url, out["a"].status, out["a"].updated) == ("http://a/1", "http://a/0", 200, when)
    assert (out["b"].url, out["b"].original_url) == ("http://b/2", "http://b/1")
    assert (out["c"].url, out["c"].original_url) == ("http://c/0", None)
    assert (out["d"].url, out["d"].status, out["d"].last_download) == ("http://d/0", None, None)


def test_counts_of_late_smaller_ids(spark):
    store = TableStore(spark, os.path.join(_base(spark), "tables"))

    def part(name, *ids):
        df = spark.createDataFrame([_row(S.ARTICLE, article_id=f"{i:024x}", pub_id="p", feed_id=f"f{i % 2}")
                                    for i in ids], S.ARTICLE)
        jobs._articles(store).append(df, name)

    part("1", 5, 9)
    assert jobs.recount_articles(store)
    part("2", 7, 9)                                     # 7 is below the largest id, 9 is saved again
    assert jobs.recount_articles(store) and not jobs.recount_articles(store)
    assert rows(store.read("counts")) == rows(counts.article_counts(jobs.current_articles(store)))
    assert store.read("counts").filter("type = 'pub'").first().n == 3


def test_entry_fields_and_whole_rejects(spark):
    store = TableStore(spark, os.path.join(_base(spark), "tables"))
    store.write("feeds", spark.createDataFrame([_row(S.FEED, feed_id="a", pub_id="p", url="http://f/a")], S.FEED))
    store.write("pubs", spark.createDataFrame([_row(S.PUB, pub_id="p", name="P")], S.PUB))
    names = [f.name for f in S.POLL_ENTRY.fields]
    entry = lambda link: tuple({"link": link, "title": "Said", "author": "Ann",
                                "published": "Tue, 30 Jan 2024 10:00:00 GMT"}.get(n) for n in names)
    jobs.download_feed(store, spark.createDataFrame(
        [_poll("a", 10, 200, "http://f/a", None, [entry("http://x/1"), entry("http://x/2")])], S.FEED_POLL),
        "2024-01-30 10:05:00")
    work = {r.link: r for r in store.read("work").collect()}
    assert (work["http://x/1"].title, work["http://x/1"].author) == ("Said", "Ann")
    page = lambda link, kind, html: _row(S.PAGE_FETCH, article_id=work[link].article_id, link=link, feed_id="a",
                                         pub_id="p", content_type=kind, html=html)
    jobs.process_pages(store, spark.createDataFrame([
        page("http://x/1", "text/html", bytearray(b"<html><body><p>Text enough for a body, one may hope.</p></body></html>")),
        page("http://x/2", "text/html", None)], S.PAGE_FETCH), "1", "2024-01-30 11:00:00")
    saved = jobs.current_articles(store).collect()
    assert [(r.entry.title, r.entry.author) for r in saved] == [("Said", "Ann")]
    bad = jobs._rejects(store).read(S.REJECT).collect()
    w = work["http://x/2"]
    assert [(r.article_id, r.feed_id, r.pub_id, r.link, r.stage, r.started, r.last_action, r.reason) for r in bad] == [
        (w.article_id, "a", "p", "http://x/2", w.stage, w.started, w.last_action, "No HTML")]


def test_a_refused_fetch_claims_no_url(spark):
    base = _base(spark)
    pages = driver_tables.page_fetches(spark, SF)
    early = (pages.withColumn("html", F.lit(None).cast("binary"))
             .withColumn("article_id", F.format_string("%024x", F.conv("article_id", 16, 10).cast("bigint") + 5000)))
    early.coalesce(1).write.mode("append").parquet(os.path.join(base, "in"))
    pages.coalesce(1).write.mode("append").parquet(os.path.join(base, "in"))
    got = {}
    for mode in ("store", "state"):
        out = os.path.join(base, mode)
        streams.stream_articles(spark, os.path.join(base, "in"), driver_tables.pubs(spark, SF), out,
                                os.path.join(base, "ck-" + mode), max_files=1, url_history=mode).awaitTermination()
        bad = spark.read.parquet(out + "_rejects").filter(~F.col("reason").contains("URL"))
        got[mode] = (sorted(r.url for r in spark.read.parquet(out).select("url").collect()),
                     sorted((r.article_id, r.reason) for r in bad.collect()))
    assert got["store"] == got["state"] and got["state"][0] and got["state"][1]


def test_stream_keeps_whole_xml_and_corrupt_records(spark):
    base = _base(spark)
    os.makedirs(os.path.join(base, "in"))
    with open(os.path.join(base, "in", "1.xml"), "w") as f:
        f.write("<response><articles>"
                "<article><sequenceId>s-1</sequenceId><id>1</id><companies><company><name>Acme</name></company></companies>"
                "<source><feed><id>4</id></feed></source></article>"
                "<article><sequenceId>2</sequenceId><id>2</id><source><feed><id>four</id></feed></source></article>"
                "</articles></response>")
    streams.stream_wire(spark, os.path.join(base, "in"), spark.createDataFrame([], S.FEED), os.path.join(base, "out"),
                        os.path.join(base, "ck"), "2024-02-01 00:00:00").awaitTermination()
    arts = spark.read.parquet(os.path.join(base, "out", "articles")).collect()
    assert len(arts) == 1 and "Acme" in bytes(arts[0].html).decode()
    bad = spark.read.parquet(os.path.join(base, "out", "rejects")).collect()
    assert len(bad) == 1 and "four" in bad[0].record
    assert wire_rejects(read_wire(spark, os.path.join(base, "in")).cache()).count() == 1


def test_archive_replay_adds_nothing(spark):
    path = os.path.join(_base(spark), "batch=1")
    raw = spark.createDataFrame([("<r/>", dt.datetime(2024, 1, 1))], "raw string, fetched_at timestamp")
    for _ in range(2):
        archive_wire(raw, path, mode="overwrite")
    assert spark.read.parquet(path).count() == 1


def test_upsert_of_a_repeated_key_is_stable(spark):
    t = spark.createDataFrame([(1, "old")], "id int, v string")
    new = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "id int, v string").repartition(3)
    assert sorted(map(tuple, tables.upsert(t, new, "id").collect())) == [(1, "a"), (2, "c")]
