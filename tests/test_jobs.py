import uuid

from pyspark.sql import functions as F

from newsdesk.operators import counts
from newsdesk.plans import jobs
from newsdesk.plans.common import _legacy_dump, _wire
from newsdesk.session import checkpoint_dir
from newsdesk.sources import driver_tables as dt
from newsdesk.store import TableStore
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
NOW = "2024-01-30 12:00:00"


def test_jobs_end_to_end(spark):
    store = TableStore(spark, checkpoint_dir(spark, "tests", uuid.uuid4().hex, "tables"))
    store.write("pubs", jobs.conform(dt.pubs(spark, SF), jobs.S.PUB))
    store.write("feeds", jobs.conform(dt.feeds(spark, SF), jobs.S.FEED))
    jobs.apply_cats(store)
    assert store.read("category_aliases").count() == 15

    due = jobs.enqueue_feeds(store, NOW)
    assert 0 < due.count() <= 25
    queued = jobs.download_feed(store, dt.feed_polls(spark, SF), NOW)
    n_work = store.read("work").count()
    assert n_work == queued.count() > 0
    assert store.read("work").select("link").distinct().count() == n_work     # unique links
    assert jobs.enqueue_feeds(store, NOW, threshold=1).count() == 0           # queue too deep

    pages = dt.page_fetches(spark, SF)
    jobs.process_pages(store, pages, "000001", NOW)
    saved = jobs.current_articles(store).count()
    jobs.process_pages(store, pages, "000001", NOW)                          # replay of the same part
    assert jobs.current_articles(store).count() == saved > 0
    assert store.read("work").count() == n_work                             # page ids were not work rows

    jobs.metabase(store, _wire(spark, SF), "000002", "2024-02-01 00:00:00")
    arts = jobs.current_articles(store)
    assert arts.filter(F.col("origin") == "webnews").count() == 1500

    assert jobs.recount_articles(store)
    assert rows(store.read("counts")) == rows(counts.article_counts(arts))
    assert not jobs.recount_articles(store)                                 # nothing new: no change

    v = jobs.merge_publications(store)
    assert jobs.merge_publications(store) == v + 1
    assert rows(store.read("pubs"), "pub_id") == rows(store.read("pubs"), "pub_id")
    pubs_now = {r.pub_id for r in store.read("pubs").select("pub_id").collect()}
    redirected = {r.old_id for r in store.read("pub_redirects").collect()}
    assert redirected and not (redirected & pubs_now)
    assert jobs.current_articles(store).join(store.read("pub_redirects"),
                                             F.col("pub_id") == F.col("old_id")).count() == 0

    jobs.unique_categories(store, NOW)
    n_cat = store.read("categories").count()
    jobs.unique_categories(store, NOW)
    assert store.read("categories").count() == n_cat > 0

    jobs.pub_cats(store)
    assert store.read("pubs").filter(F.array_contains("categories", "News")).count() > 0
    out = checkpoint_dir(spark, "tests", uuid.uuid4().hex, "export")
    jobs.pub_export(store, out)
    assert spark.read.option("header", True).csv(out).columns == ["ID", "Pub Name", "Homepage", "Added"]


def test_prime_from_legacy_dump(spark):
    store = TableStore(spark, checkpoint_dir(spark, "tests", uuid.uuid4().hex, "tables"))
    jobs.prime(store, _legacy_dump(spark, SF))
    p, f = store.read("pubs"), store.read("feeds")
    assert p.count() == 150 and f.count() == sum(k % 4 for k in range(150))
    assert p.schema == jobs.S.PUB and store.versions("pubs") == [1]


def test_conditional_poll_fields_round_trip(spark):
    # Fix: the poll update writes `modified` and the next enqueue hands the
    # same field to the fetcher (one name, so conditional polls work)
    import datetime as dt
    store = TableStore(spark, checkpoint_dir(spark, "tests", uuid.uuid4().hex, "tables"))
    cols = [f.name for f in jobs.S.FEED.fields]
    feed = {"feed_id": "a", "url": "http://f/a", "bozo": 0}
    store.write("feeds", spark.createDataFrame([tuple(feed.get(c) for c in cols)], jobs.S.FEED))
    t0 = dt.datetime(2024, 1, 30, 10)
    polls = spark.createDataFrame([("a", t0, 200, 0, "http://f/a", '"e1"', "Tue, 30 Jan 2024 10:00:00 GMT", None, [])],
                                  jobs.S.FEED_POLL)
    jobs.download_feed(store, polls, "2024-01-30 10:00:00")
    due = jobs.enqueue_feeds(store, "2024-01-30 12:00:00").collect()
    assert [(r.feed_id, r.etag, r.modified) for r in due] == [("a", '"e1"', "Tue, 30 Jan 2024 10:00:00 GMT")]
