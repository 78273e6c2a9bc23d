import os
import uuid

from pyspark.sql import functions as F

from newsdesk.operators import counts
from newsdesk.session import checkpoint_dir
from newsdesk.streaming import jobs
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["type", "id", "n"] and df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_stream_counts_equal_batch(spark):
    base = checkpoint_dir(spark, "tests", uuid.uuid4().hex)
    a = spark.createDataFrame([(f"{i:024x}", f"p{i % 4}", f"f{i % 3}") for i in range(40)],
                              "article_id string, pub_id string, feed_id string")
    a.repartitionByRange(3, "article_id").write.parquet(os.path.join(base, "in"))
    q = jobs.stream_article_counts(spark, os.path.join(base, "in"), os.path.join(base, "out"),
                                   os.path.join(base, "ck"), schema=a.schema, max_files=1)
    q.awaitTermination()
    assert rows(jobs.current_counts(spark, os.path.join(base, "out"))) == rows(counts.article_counts(a))
    # a restart from the same checkpoint reads nothing new and changes nothing
    q = jobs.stream_article_counts(spark, os.path.join(base, "in"), os.path.join(base, "out"),
                                   os.path.join(base, "ck"), schema=a.schema, max_files=1)
    q.awaitTermination()
    assert rows(jobs.current_counts(spark, os.path.join(base, "out"))) == rows(counts.article_counts(a))


def test_registered_queries_run_small(spark):
    import __spark_entry__ as E
    for name in ["feeds_due", "clean_url", "wire_to_article", "stream_feed_entries", "extract_content"]:
        assert E.queries()[name](spark, SF).count() >= 0


def test_landed_polls_batch_and_stream(spark):
    import datetime as dt
    from newsdesk import schema as S
    from newsdesk.sources.files import read_feed_fetches
    base = checkpoint_dir(spark, "tests", uuid.uuid4().hex)
    t0 = dt.datetime(2024, 1, 1)
    polls = spark.createDataFrame([
        ("f1", t0, 200, 0, None, None, None, None, [("http://a/1?utm_x=1", "A", "T", "Mon, 01 Jan 2024 00:00:00 GMT")]),
        ("f2", t0, 304, 0, None, None, None, None, [("http://a/2", None, None, None)])], S.FEED_POLL)
    polls.write.json(os.path.join(base, "in"))
    batch = read_feed_fetches(spark, os.path.join(base, "in"))
    assert rows(batch, "feed_id", "status") == [("f1", 200), ("f2", 304)]
    stream = read_feed_fetches(spark, os.path.join(base, "in"), stream=True)
    q = (stream.writeStream.format("memory").queryName("landed_polls").trigger(availableNow=True)
         .option("checkpointLocation", os.path.join(base, "ck")).start())
    q.awaitTermination()
    assert rows(spark.table("landed_polls"), "feed_id", "status") == rows(batch, "feed_id", "status")


def test_ship_package(spark):
    from newsdesk.session import ship_package
    p = ship_package(spark)
    assert p.endswith(".zip") and os.path.exists(p) and ship_package(spark) == p


def test_stream_entries_history_across_batches_and_restart(spark):
    from newsdesk import schema as S
    import datetime as dt
    base = checkpoint_dir(spark, "tests", uuid.uuid4().hex)
    t0 = dt.datetime(2024, 1, 1)
    schema = jobs._poll_schema()
    mk = lambda i, links: (f"f{i}", t0 + dt.timedelta(hours=i), 200, 0, None, None, None, None,
                           [(l, None, None, None) for l in links], i)
    spark.createDataFrame([mk(1, ["a", "b"]), mk(2, ["b", "c"])], schema).write.parquet(os.path.join(base, "in", "p1"))
    args = (os.path.join(base, "in", "*"), os.path.join(base, "out"), os.path.join(base, "ck"))
    jobs.stream_feed_entries(spark, *args).awaitTermination()
    spark.createDataFrame([mk(3, ["a", "d", "d"])], schema).write.parquet(os.path.join(base, "in", "p2"))
    jobs.stream_feed_entries(spark, *args).awaitTermination()       # restart: history kept in state
    out = spark.read.parquet(os.path.join(base, "out"))
    assert rows(out, "link") == [("a",), ("b",), ("c",), ("d",)]


def test_stream_counts_compaction(spark):
    base = checkpoint_dir(spark, "tests", uuid.uuid4().hex)
    mk = lambda lo, hi: spark.createDataFrame([(f"{i:024x}", f"p{i % 4}", f"f{i % 3}") for i in range(lo, hi)],
                                              "article_id string, pub_id string, feed_id string")
    args = lambda: (os.path.join(base, "in"), os.path.join(base, "out"), os.path.join(base, "ck"))
    mk(0, 20).coalesce(1).write.mode("append").parquet(os.path.join(base, "in"))
    mk(20, 30).coalesce(1).write.mode("append").parquet(os.path.join(base, "in"))
    jobs.stream_article_counts(spark, *args(), schema=mk(0, 1).schema, max_files=1).awaitTermination()
    top = jobs.compact_counts(spark, os.path.join(base, "out"))
    assert top is not None and not jobs._has_data(spark, os.path.join(base, "out"))
    mk(30, 45).coalesce(1).write.mode("append").parquet(os.path.join(base, "in"))
    jobs.stream_article_counts(spark, *args(), schema=mk(0, 1).schema, max_files=1).awaitTermination()
    assert rows(jobs.current_counts(spark, os.path.join(base, "out"))) == rows(counts.article_counts(mk(0, 45)))
    jobs.compact_counts(spark, os.path.join(base, "out"))
    assert rows(jobs.current_counts(spark, os.path.join(base, "out"))) == rows(counts.article_counts(mk(0, 45)))


def test_stream_articles_url_history_modes(spark):
    from newsdesk.sources import driver_tables as dt
    base = checkpoint_dir(spark, "tests", uuid.uuid4().hex)
    pages = dt.page_fetches(spark, SF)
    again = pages.withColumn("article_id", F.format_string("%024x", F.conv("article_id", 16, 10).cast("bigint") + 1000))
    pages.coalesce(1).write.mode("append").parquet(os.path.join(base, "in"))
    again.coalesce(1).write.mode("append").parquet(os.path.join(base, "in"))   # same urls, new ids, later
    saved = {}
    for mode in ("store", "state"):
        out = os.path.join(base, mode)
        jobs.stream_articles(spark, os.path.join(base, "in"), dt.pubs(spark, SF), out,
                             os.path.join(base, "ck-" + mode), max_files=1, url_history=mode).awaitTermination()
        saved[mode] = rows(spark.read.parquet(out), "article_id")
    assert saved["store"] == saved["state"] and len(saved["store"]) > 0
    assert all(int(a, 16) < 1000 for (a,) in saved["store"])      # first arrival of each url wins
    dups = spark.read.parquet(os.path.join(base, "store_rejects")).filter(F.col("reason").contains("URL"))
    assert dups.count() == len(saved["store"])                       # store mode reports each copy


def test_stream_wire_batch_clock(spark):
    from newsdesk.streaming import jobs as sj
    from tests.test_wire_extract import GOLDEN
    import shutil
    base = checkpoint_dir(spark, "tests", uuid.uuid4().hex)
    os.makedirs(os.path.join(base, "in"))
    shutil.copy(GOLDEN, os.path.join(base, "in", "r1.xml"))
    feeds = spark.createDataFrame([], "feed_id string, pub_id string, metabase_id bigint")
    sj.stream_wire(spark, os.path.join(base, "in"), feeds, os.path.join(base, "out"),
                   os.path.join(base, "ck"), None).awaitTermination()
    a = spark.read.parquet(os.path.join(base, "out", "articles"))
    assert a.count() == 3
    # newest harvest date of the batch is 2014-11-21T07:30Z: ids start with its epoch seconds
    import datetime as dt
    want = "%08x" % int(dt.datetime(2014, 11, 21, 7, 30, tzinfo=dt.timezone.utc).timestamp())
    assert {r.article_id[:8] for r in a.collect()} == {want}


def test_stream_entries_from_json_polls(spark):
    import datetime as dt
    base = checkpoint_dir(spark, "tests", uuid.uuid4().hex)
    t0 = dt.datetime(2024, 1, 1)
    spark.createDataFrame([("f1", t0, 200, 0, None, None, None, None, [("http://a/1", None, None, None)], 1)],
                          jobs._poll_schema()).write.json(os.path.join(base, "in"))
    jobs.stream_feed_entries(spark, os.path.join(base, "in"), os.path.join(base, "out"),
                             os.path.join(base, "ck"), fmt="json").awaitTermination()
    assert rows(spark.read.parquet(os.path.join(base, "out")), "link") == [("http://a/1",)]


def test_stream_wire_archive(spark):
    import shutil
    from newsdesk.streaming import jobs as sj
    from tests.test_wire_extract import GOLDEN
    base = checkpoint_dir(spark, "tests", uuid.uuid4().hex)
    os.makedirs(os.path.join(base, "in"))
    shutil.copy(GOLDEN, os.path.join(base, "in", "r1.xml"))
    sj.stream_wire_archive(spark, os.path.join(base, "in"), os.path.join(base, "arch"),
                           os.path.join(base, "ck")).awaitTermination()
    got = spark.read.parquet(os.path.join(base, "arch"))
    assert got.count() == 1 and "fetch_date" in got.columns
    assert got.first().raw == open(GOLDEN).read()
