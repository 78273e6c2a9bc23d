"""Recounts after late, rewritten and merged parts; two writers of one table;
part names of several jobs; document order and failures of the newswire."""

import os
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from newsdesk import schema as S
from newsdesk.operators import counts
from newsdesk.plans import jobs
from newsdesk.session import checkpoint_dir
from newsdesk.sources.wire import WireFailure
from newsdesk.store import ConflictError, TableStore, url_index
from tests.conftest import rows


@pytest.fixture
def store(spark):
    return TableStore(spark, os.path.join(checkpoint_dir(spark, "tests", uuid.uuid4().hex), "tables"))


def _row(schema, **values):
    return tuple(values.get(n) for n in schema.names)


def _part(store, name, *articles):
    df = store.spark.createDataFrame([_row(S.ARTICLE, article_id=f"{i:024x}", pub_id=p, feed_id=f"f{i % 2}") for i, p in articles], S.ARTICLE)
    jobs._articles(store).append(df, name)


def _full(store):
    return rows(counts.article_counts(jobs.current_articles(store)))


def test_late_rewritten_and_merged_parts(spark, store):
    pubs = [("a", "Same"), ("b", "Same"), ("c", "Other")]
    store.write("pubs", spark.createDataFrame([_row(S.PUB, pub_id=p, name=n) for p, n in pubs], S.PUB))
    store.write("feeds", spark.createDataFrame([], S.FEED))
    _part(store, "2", (5, "a"), (9, "b"))
    assert jobs.recount_articles(store) and rows(store.read("counts")) == _full(store)
    _part(store, "1", (3, "a"), (5, "c"), (7, "b"))                 # late: its name sorts first, part 2 still wins id 5
    assert jobs.recount_articles(store) and rows(store.read("counts")) == _full(store)
    _part(store, "2", (9, "a"), (11, "b"))                         # written again: id 5 is now that of part 1
    assert jobs.recount_articles(store) and rows(store.read("counts")) == _full(store)
    assert not jobs.recount_articles(store)
    assert jobs.vacuum_articles(store) and rows(store.read("counts")) == _full(store)
    jobs.merge_publications(store)                                 # b goes into a, in the stored counts as well
    assert rows(store.read("counts")) == _full(store)
    assert {r.id: r.n for r in store.read("counts").filter("type = 'pub'").collect()} == {"a": 4, "c": 1}
    _part(store, "3", (13, "b"))                                   # an article of the old pub after the merge
    assert jobs.recount_articles(store) and rows(store.read("counts")) == _full(store)
    _part(store, "2")                                              # emptied
    jobs._articles(store).vacuum()                                 # what was counted is gone: counted anew
    assert jobs.recount_articles(store) and rows(store.read("counts")) == _full(store)


def test_two_writers_both_survive(spark, store):
    schema = "k string, n int"
    store.write("t", spark.createDataFrame([("x", 0)], schema))
    start = threading.Barrier(2)

    def writer(name):
        seen = []

        def change(t):
            if not seen:
                seen.append(1)
                start.wait(30)                                     # both have read version 1
            return t.unionByName(spark.createDataFrame([(name, 1)], schema))
        store.update("t", change, schema)

    threads = [threading.Thread(target=writer, args=(n,)) for n in ("a", "b")]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(r.k for r in store.read("t").collect()) == ["a", "b", "x"]
    assert store.versions("t") == [1, 2, 3]
    with pytest.raises(ConflictError):
        store.write("t", store.read("t", schema, 1), base=1)
    assert store.vacuum("t", keep=1) == [1, 2] and store.read("t").count() == 3


def test_feed_and_newswire_jobs_may_use_one_part_name(spark, store):
    store.write("pubs", spark.createDataFrame([_row(S.PUB, pub_id="p", name="P")], S.PUB))
    store.write("feeds", spark.createDataFrame([], S.FEED))
    html = bytearray(b"<html><body><p>Text enough for a body, one may hope.</p></body></html>")
    page = _row(S.PAGE_FETCH, article_id="%024x" % 1, link="http://x/1", pub_id="p", content_type="text/html", html=html)
    jobs.process_pages(store, spark.createDataFrame([page], S.PAGE_FETCH), "20240130T1200", "2024-01-30 12:00:00")
    path = _responses(spark, ("1", "<response><articles>" + "".join(_article(i, i) for i in (1, 2, 3)) + "</articles></response>"))
    jobs.metabase_files(store, path, "20240130T1200", "2024-01-30 12:00:00")
    assert sorted(r.origin for r in jobs.current_articles(store).collect()) == ["rss", "webnews", "webnews", "webnews"]
    assert jobs.recount_articles(store) and rows(store.read("counts")) == _full(store)


def _article(seq, n):
    return (f"<article><sequenceId>{seq}</sequenceId><id>{n}</id><url>http://w/{n}</url>"
            f"<source><feed><id>{n % 2}</id></feed></source></article>")


def _responses(spark, *files):
    path = os.path.join(checkpoint_dir(spark, "tests", uuid.uuid4().hex), "wire")
    os.makedirs(path)
    for name, text in files:
        with open(os.path.join(path, f"{name}.xml"), "w") as f:
            f.write(text)
    return path


def test_cursor_is_the_last_of_the_document(spark, store):
    store.write("pubs", spark.createDataFrame([], S.PUB))
    store.write("feeds", spark.createDataFrame([], S.FEED))
    cursor = lambda: store.read("wire_cursor").first().sequence_id
    body = lambda *ids: "<response><articles>" + "".join(_article(s, k) for k, s in enumerate(ids)) + "</articles></response>"
    jobs.metabase_files(store, _responses(spark, ("1", body(900, 1000, 950))), "1", "2024-02-01 00:00:00")
    assert cursor() == "950"
    jobs.metabase_files(store, _responses(spark, ("1", body(7)), ("2", body("s-9", "s-10", "s-1"))), "2", "2024-02-01 00:00:00")
    assert cursor() == "s-1"
    jobs.metabase_files(store, _responses(spark, ("1", body())), "3", "2024-02-01 00:00:00")
    assert cursor() == "s-1"                                       # a batch without articles leaves it
    assert store.read("pubs").count() == 2


def test_a_failure_stops_and_bad_records_are_kept(spark, store):
    store.write("pubs", spark.createDataFrame([], S.PUB))
    store.write("feeds", spark.createDataFrame([], S.FEED))
    bad = _responses(spark, ("1", "<response><articles>" + _article(1, 1) + "</articles></response>"),
                     ("2", "<response><status>FAILURE</status><messageCode>1003</messageCode><userMessage>Too early</userMessage></response>"))
    with pytest.raises(WireFailure, match="1003 Too early"):
        jobs.metabase_files(store, bad, "1", "2024-02-01 00:00:00")
    assert not jobs._articles(store).parts() and not store.exists("wire_cursor")
    mixed = _responses(spark, ("1", "<response><status>SUCCESS</status><articles>" + _article(1, 1)
                               + "<article><id>2</id><source><feed><id>four</id></feed></source></article></articles></response>"))
    jobs.metabase_files(store, mixed, "1", "2024-02-01 00:00:00")
    found = jobs._rejects(store).read(S.REJECT).collect()
    assert [(r.reason, "four" in r.data, r.stage) for r in found] == [("Malformed article", True, "metabase")]
    assert jobs.current_articles(store).count() == 1


def test_url_index_reads_touched_buckets_only(spark, store):
    index = url_index(store, buckets=16)
    every = spark.range(400).select(F.format_string("http://x/%d", "id").alias("url"), F.format_string("%024x", "id").alias("article_id"))
    index.add(every.filter("id < 200") if "id" in every.columns else every.limit(0).union(every), "1")
    index.add(spark.createDataFrame([("http://x/7", "%024x" % 1007), (None, "n")], "url string, article_id string"), "2")
    asked = spark.createDataFrame([("http://x/7",), ("http://x/none",), (None,)], "url string")
    got = index.stored(asked)
    assert sorted(r.article_id for r in got.collect()) == ["%024x" % 7, "%024x" % 1007]
    plan = got._jdf.queryExecution().executedPlan().toString()
    buckets = {r.b for r in asked.filter("url is not null").select(index.bucket().alias("b")).collect()}
    assert "PartitionFilters" in plan and len(buckets) <= 2
    files = {f.split("bucket=")[1].split("/")[0] for f in got.inputFiles()}
    assert {int(b) for b in files} <= set(range(16))
    assert [r.article_id for r in index.stored(asked, exclude_part="2").collect()] == ["%024x" % 7]
    index.compact()
    assert len(index.parts.parts()) == 1 and sorted(r.article_id for r in index.stored(asked).collect()) == ["%024x" % 7, "%024x" % 1007]


def test_no_html_in_an_exchange(spark):
    from newsdesk.plans.rss import process_pages
    from newsdesk.sources import driver_tables as dt
    d = "/root/testdata/sf0.001"
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pages = jobs.conform(dt.page_fetches(spark, d), S.PAGE_FETCH)
        keep, rejects, cached = process_pages(pages, dt.pubs(spark, d), spark.createDataFrame([], "article_id string, url string"))
        for df in (keep, rejects):
            plan = df._jdf.queryExecution().executedPlan().toString()
            exchanges = [line for line in plan.split("\n") if "Exchange" in line]
            assert exchanges
            tree = plan.split("\n")
            for i, line in enumerate(tree):
                if "Exchange" in line and "Broadcast" not in line:       # what feeds an exchange
                    below = next(x for x in tree[i + 1:] if "Project" in x or "Scan" in x or "Filter" in x)
                    assert " html#" not in below.replace("body_html", ""), below
        assert keep.count() > 0
        cached.unpersist()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
