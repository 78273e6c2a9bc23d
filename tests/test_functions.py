import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from newsdesk.functions import dates, ids, text, urls

URLS = {
    "http://a.com/p?a=1&a=2": "http://a.com/p?a=1&a=2",
    "http://a.com/p?ref=25&ref=2": "http://a.com/p",          # first value decides
    "http://a.com/p?ref=2&ref=25": "http://a.com/p?ref=2&ref=25",
    "http://a.com/p?x=rss": "http://a.com/p",
    "http://a.com/p?k": "http://a.com/p?k=",
    "http://a.com/p?=v": "http://a.com/p",
    "http://a.com/p?a.99b=1": "http://a.com/p",
    "http://a.com/p?q=a~b*c%20d": "http://a.com/p?q=a~b%2Ac+d",
    "http://a.com/p?atc=1": "http://a.com/p",
    "http://a.com/p?z=1&b=2#frag": "http://a.com/p?b=2&z=1#frag",
    "http://a.com/p?utm_source=x&fbclid=2&ana=RSS&s=article_search&attr=all": "http://a.com/p",
    "http://a.com/p#f?utm_x=1": "http://a.com/p#f?utm_x=1",
    "http://a.com/p?a=%zz&b=1": "http://a.com/p?b=1",
    "http://a.com/p?b=2&a=1&b=1": "http://a.com/p?a=1&b=2&b=1",
    "http://a.com/p?source=x&tag=y&keep=1": "http://a.com/p?keep=1",
    "HTTPS://A.com/P?b=1": "https://A.com/P?b=1",                 # scheme in lower case only
    "no-scheme/path?utm_x=1": "no-scheme/path",
}


def test_clean_url_rules(spark):
    df = spark.createDataFrame([(k,) for k in URLS], "u string")
    got = {r.u: r.c for r in df.select("u", urls.clean_url("u").alias("c")).collect()}
    assert got == URLS


def test_fix_cmp_key_is_dropped(spark):
    # the reference's sorted-list search never finds CMP; set membership does
    df = spark.createDataFrame([("http://a.com/p?CMP=1&x=2",)], "u string")
    assert df.select(urls.clean_url("u")).first()[0] == "http://a.com/p?x=2"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "utm_x", "ref", "CMP", "k", "fbx", "z"]),
                          st.sampled_from(["1", "25", "rss", "", "x y", "~*"])), max_size=6))
def test_clean_url_idempotent(spark, pairs):
    q = "&".join(f"{k}={v}" for k, v in pairs)
    df = spark.createDataFrame([("http://h.example/p" + ("?" + q if q else ""),)], "u string")
    once = df.select(urls.clean_url("u").alias("u"))
    twice = once.select(urls.clean_url("u").alias("u"))
    assert once.first()[0] == twice.first()[0]


def test_resolve_url(spark):
    df = spark.createDataFrame([("/x", "https://h.example/a?b"), (None, "http://h/a"),
                                ("http://o.example/z", "http://h/a"), ("", "http://h/a")], "loc string, link string")
    got = [r[0] for r in df.select(urls.resolve_url("loc", "link")).collect()]
    assert got == ["https://h.example/x", "http://h/a", "http://o.example/z", "http://h/a"]


def test_resolve_relative_targets(spark):
    link = "https://h.example/a/b/c?q=1#f"
    cases = {"next.html": "https://h.example/a/b/next.html", "../z": "https://h.example/a/z", "?p=2": "https://h.example/a/b/c?p=2",
             "./x/../y?k=..": "https://h.example/a/b/y?k=..", "../../../up": "https://h.example/up", "#top": "https://h.example/a/b/c?q=1#top",
             "..": "https://h.example/a/", "//o.example/p": "https://o.example/p", "mailto:a@b": link}
    df = spark.createDataFrame([(k, link) for k in cases] + [("x", "http://h.example")], "loc string, link string")
    got = {r[0]: r[1] for r in df.select("loc", urls.resolve_url("loc", "link")).collect()}
    assert got == {**cases, "x": "http://h.example/x"}


def test_loose_dates(spark):
    day, ten = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 10)
    cases = {"2024-01-02 10:00:00 UTC": ten, "2024-01-02 10:00:00 GMT": ten, "2 January 2024": day, "January 2, 2024 3:04 PM": dt.datetime(2024, 1, 2, 15, 4),
             "Jan 2, 2024 15:04:05": dt.datetime(2024, 1, 2, 15, 4, 5), "2024-01-02T10:00:00+0000": ten}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    assert {r[0]: r[1] for r in df.select("s", dates.parse_loose_date("s")).collect()} == cases


def test_dates(spark):
    df = spark.createDataFrame([(x,) for x in [
        "Mon, 02 Jan 2006 15:04:05 GMT", "Mon, 02 Jan 2006 15:04:05 -0700", "2014-11-20T10:00:00Z",
        "2014-11-20", "", "garbage", None]], "s string")
    r = df.select(dates.parse_rfc1123("s").alias("a"), dates.parse_rfc3339_strict("s").alias("b"),
                  dates.parse_loose_date("s").alias("c")).collect()
    assert r[0].a == dt.datetime(2006, 1, 2, 15, 4, 5)
    assert r[1].a == dt.datetime(2006, 1, 2, 22, 4, 5)
    assert r[2].a is None and r[2].b == dt.datetime(2014, 11, 20, 10, 0)
    assert r[3].b is None and r[3].c == dt.datetime(2014, 11, 20)   # bare date is not RFC 3339
    assert all(x.a is None and x.b is None and x.c is None for x in r[4:])  # Fix: NULL, not raw text


def test_rfc3339_fallbacks(spark):
    df = spark.createDataFrame([("2014-11-20", "2014-11-21T09:30:00+02:00"), ("x", "y")], "p string, h string")
    r = df.select(dates.parse_rfc3339("p", "h", F.lit("2024-02-01 00:00:00").cast("timestamp"))).collect()
    assert r[0][0] == dt.datetime(2014, 11, 21, 7, 30) and r[1][0] == dt.datetime(2024, 2, 1)


def test_authors_slugs_bodies(spark):
    df = spark.createDataFrame([("By Jane",), ("By By Jane",), ("By By By Jane",), ("by jane",), (None,)], "a string")
    assert [r[0] for r in df.select(text.clean_author("a")).collect()] == ["Jane", "Jane", "By Jane", "by jane", None]
    c = spark.createDataFrame([("Health Care",)], "c string")
    assert c.select(text.category_slug("c"), text.category_key("c")).first() == ("health_care", "HealthCare")
    b = spark.createDataFrame([("",), ("123456789",), ("1234567890",), ("éééééé",), (None,)], "b string")
    got = [tuple(r) for r in b.select(text.empty_body_flag("b", 1), text.empty_body_flag("b", 10)).collect()]
    # six 2-byte letters are 12 bytes: not empty for the 10-byte rule
    assert got == [(True, True), (False, True), (False, False), (False, False), (True, True)]


def test_ids(spark):
    df = spark.createDataFrame([("5f0c5b2e1c9d440000a1b2c3",), ("5F0C5B2E1C9D440000A1B2C3",),
                                ("5f0c5b2e1c9d440000a1b2c",), ("5f0c5b2e1c9d440000a1b2cg",)], "s string")
    r = df.select(ids.is_object_id("s"), ids.objectid_time("s")).collect()
    assert [x[0] for x in r] == [True, True, False, False]
    assert r[0][1] == dt.datetime(2020, 7, 13, 13, 1, 34) and r[2][1] is None
    m = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7), "k")], "t timestamp, k string")
    a, b = m.select(ids.make_id("t", "k")).first()[0], m.select(ids.make_id("t", "k")).first()[0]
    assert a == b and len(a) == 24 and a.startswith("65920087")
