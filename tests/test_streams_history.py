"""Streams against all history: late copies and restarts, publications created
while a stream runs, ids saved again, order of documents, whole rejects."""

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from newsdesk import schema as S
from newsdesk.operators import counts
from newsdesk.session import checkpoint_dir
from newsdesk.store import TableStore
from newsdesk.streaming import jobs as streams
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 30)


def _base(spark):
    return checkpoint_dir(spark, "tests", uuid.uuid4().hex)


def _row(schema, **values):
    return tuple(values.get(n) for n in schema.names)


def _land(spark, base, rows_, schema):
    spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").parquet(os.path.join(base, "in"))


def test_links_late_copies_and_restarts(spark):
    base = _base(spark)
    names = [f.name for f in S.POLL_ENTRY.fields]

    def poll(feed, hour, *links):
        entries = [tuple({"link": x, "title": f"t {feed}", "author": "A"}.get(n) for n in names) for x in links]
        return (feed, T0 + dt.timedelta(hours=hour), 200, 0, None, None, None, None, entries)

    def run():
        streams.stream_feed_entries(spark, os.path.join(base, "in"), os.path.join(base, "out"), os.path.join(base, "ck")).awaitTermination()
        return {r.link: (r.feed_id, r.fetched_at.hour, r.title) for r in spark.read.parquet(os.path.join(base, "out")).collect()}

    _land(spark, base, [poll("b", 2, "x", "y"), poll("a", 1, "x", "x", None)], S.FEED_POLL)
    first = run()
    assert first == {"x": ("a", 1, "t a"), "y": ("b", 2, "t b")}          # the earliest copy decides
    _land(spark, base, [poll("a", -4000, "y", "z")], S.FEED_POLL)          # months late: y is known, z is new
    assert run() == {**first, "z": ("a", 8, "t a")}
    _land(spark, base, [poll("c", 30, "x", "y", "z")], S.FEED_POLL)        # a restart finds all of them
    assert len(run()) == 3
    state = os.path.join(base, "ck", "state")
    assert not os.path.isdir(state) or not any(files for _, _, files in os.walk(state))


def test_a_publication_created_while_the_stream_runs(spark):
    base = _base(spark)
    store = TableStore(spark, os.path.join(base, "tables"))
    store.write("pubs", spark.createDataFrame([_row(S.PUB, pub_id="p", name="P")], S.PUB))
    html = bytearray(b"<html><body><p>Text enough for a body, one may hope.</p></body></html>")

    def page(n, pub, **more):
        return _row(S.PAGE_FETCH, article_id="%024x" % n, link=f"http://x/{more.pop('link', n)}", pub_id=pub, feed_id="f", fetched_at=T0,
                    title="Said", content_type="text/html", html=more.get("html", html))

    def run(mode):
        streams.stream_articles(spark, os.path.join(base, "in"), lambda: store.read("pubs"), os.path.join(base, mode),
                                os.path.join(base, "ck-" + mode), url_history=mode).awaitTermination()
        good = spark.read.parquet(os.path.join(base, mode))
        bad = spark.read.parquet(os.path.join(base, mode + "_rejects"))
        return rows(good, "url"), bad

    _land(spark, base, [page(1, "p"), page(2, "q"), page(3, "p", html=None)], S.PAGE_FETCH)
    for mode in ("store", "state"):
        urls, bad = run(mode)
        assert urls == [("http://x/1",)]
        found = {r.article_id[-1]: r for r in bad.collect()}
        assert {k: r.reason for k, r in found.items()} == {"2": "No pub found", "3": "No HTML"}
        r = found["3"]                                                      # a whole work row, not three columns
        assert (r.feed_id, r.pub_id, r.link, r.title, r.stage, r.started, r.added) == (
            "f", "p", "http://x/3", "Said", "download-entry", T0, T0)
    store.update("pubs", lambda t: t.unionByName(spark.createDataFrame([_row(S.PUB, pub_id="q", name="Q")], S.PUB)), S.PUB)
    _land(spark, base, [page(4, "q"), page(5, "q", link=4), page(6, "p", link=1)], S.PAGE_FETCH)
    for mode in ("store", "state"):
        assert run(mode)[0] == [("http://x/1",), ("http://x/4",)]


def test_counts_of_an_id_saved_again(spark):
    base = _base(spark)
    schema = "article_id string, pub_id string, feed_id string"
    batches = [[("1", "a", "f"), ("2", "a", "f"), ("2", "a", "f")], [("2", "b", "f"), ("3", "b", "g")], [("1", "a", "f"), ("3", None, "g")]]
    last = {}
    for n, b in enumerate(batches):
        _land(spark, base, b, schema)
        streams.stream_article_counts(spark, os.path.join(base, "in"), os.path.join(base, "out"), os.path.join(base, "ck"),
                                      schema=spark.createDataFrame([], schema).schema).awaitTermination()
        last.update({r[0]: r for r in b})
        want = rows(counts.article_counts(spark.createDataFrame(list(last.values()), schema)))
        assert rows(streams.current_counts(spark, os.path.join(base, "out"))) == want
        if n == 1:
            streams.compact_counts(spark, os.path.join(base, "out"))
            assert rows(streams.current_counts(spark, os.path.join(base, "out"))) == want


def test_newswire_order_and_new_feeds(spark):
    base = _base(spark)
    os.makedirs(os.path.join(base, "in"))
    feeds = [[]]

    def response(name, *ids):
        body = "".join(f"<article><sequenceId>{s}</sequenceId><id>{s}</id><source><feed><id>7</id></feed></source></article>" for s in ids)
        with open(os.path.join(base, "in", name), "w") as f:
            f.write(f"<response><articles>{body}</articles></response>")

    def run():
        streams.stream_wire(spark, os.path.join(base, "in"), lambda: spark.createDataFrame(feeds[0], S.FEED), os.path.join(base, "out"),
                            os.path.join(base, "ck"), "2024-02-01 00:00:00").awaitTermination()
        cursor = spark.read.parquet(os.path.join(base, "out", "cursor"))
        return cursor.orderBy(F.desc("batch")).first().sequence_id, spark.read.parquet(os.path.join(base, "out", "articles"))

    feeds[0] = [_row(S.FEED, feed_id="known", pub_id="kp", metabase_id=8)]
    response("1.xml", 900, 1000, 950)
    seq, arts = run()
    assert seq == "950" and {r.feed_id for r in arts.collect()} != {"known"}
    feeds[0] = [_row(S.FEED, feed_id="known", pub_id="kp", metabase_id=9)]
    with open(os.path.join(base, "in", "2.xml"), "w") as f:
        f.write("<response><articles><article><sequenceId>s-2</sequenceId><id>x</id><source><feed><id>9</id></feed></source></article></articles></response>")
    seq, arts = run()
    assert seq == "s-2" and arts.filter("feed_id = 'known'").count() == 1
