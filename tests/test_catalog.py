from newsdesk.operators import catalog
from tests.conftest import rows


def _pubs(spark):
    data = [(f"{i:024x}", f"Name{i % 7}", i % 5 == 0) for i in range(45)]
    return spark.createDataFrame(data, "pub_id string, name string, deleted boolean")


def test_search_by_id_regex_sort_and_limits(spark):
    p = _pubs(spark)
    assert rows(catalog.search_pubs(p, f"{3:024X}"), "pub_id") == [(f"{3:024x}",)]   # id query, any case
    assert catalog.search_pubs(p, f"{5:024x}").count() == 0                           # deleted is hidden
    assert {r.name for r in catalog.search_pubs(p, "name[12]", limit=100).collect()} == {"Name1", "Name2"}
    assert catalog.search_pubs(p, "NAME1").count() > 0                                # case-insensitive
    assert catalog.search_pubs(p, None, limit=0).count() == 20                        # bad limit -> 20
    assert catalog.search_pubs(p, None, limit=10001).count() == 20
    first = catalog.search_pubs(p, None, sort="-name", limit=1).first()
    assert first.name == "Name6"
    page2 = [r.pub_id for r in catalog.search_pubs(p, None, limit=10, offset=10).collect()]
    page1 = [r.pub_id for r in catalog.search_pubs(p, None, limit=10, offset=-3).collect()]   # bad offset -> 0
    assert len(page2) == 10 and not set(page1) & set(page2)


def test_totals_and_page_links(spark):
    p = _pubs(spark)                    # 36 visible pubs
    t = catalog.search_pubs_total(p, None, 10)
    assert tuple(t.first()) == (36, 4)
    first = catalog.page_links(t, 10, 0).first()
    assert (first.first, first.prev, first.next, first.last) == (None, None, 10, 30)
    mid = catalog.page_links(t, 10, 20).first()
    assert (mid.first, mid.prev, mid.next, mid.last) == (0, 10, 30, 30)
    one = catalog.page_links(catalog.search_pubs_total(p, None, 100), 100, 0).first()
    assert (one.first, one.prev, one.next, one.last) == (None, None, None, None)


def test_feed_labels(spark):
    import datetime as dt
    from newsdesk import schema as S
    cols = [f.name for f in S.FEED.fields]
    f = spark.createDataFrame([tuple({"feed_id": "a", "pub_id": "p", "url": "u", "metabase_id": 7,
                                      "last_download": dt.datetime(2024, 1, 1)}.get(c) for c in cols)], S.FEED)
    _pub, feeds, _arts = catalog.pub_overview(_pubs(spark), f, spark.createDataFrame(
        [], "article_id string, pub_id string, feed_id string"), "p")
    r = feeds.first()
    assert (r.last_download, r.next_download, r.is_newswire) == ("2024-01-01 00:00:00", "Soon", True)


def test_pub_feeds_ranks_all_feeds(spark, tmp_path):
    """The query orders every visible feed of the events, not one in seven (F2)."""
    import datetime as dt
    from newsdesk.plans.registry import QUERIES
    spark.createDataFrame([(u, dt.datetime(2024, 1, 1), u, "view", 1.0, "{}") for u in range(1, 41)],
                          "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
                          ).write.parquet(f"{tmp_path}/events.parquet")
    got = [r.feed_id for r in QUERIES["pub_feeds"](spark, str(tmp_path)).collect()]
    ids = sorted((u for u in range(1, 41) if u % 13), key=lambda u: f"http://feeds.example.com/{u}.xml")
    assert got == ["%024x" % u for u in ids[:20]]
