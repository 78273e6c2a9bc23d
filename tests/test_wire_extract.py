import datetime as dt
import os

from pyspark.sql import functions as F

from newsdesk.functions import htmltree as ht
from newsdesk.operators import wire
from newsdesk.operators.extract import _content, _xpath_row
from newsdesk.sources.wire import read_wire, read_wire_status

GOLDEN = os.path.join(os.path.dirname(__file__), "golden", "wire_batch.xml")


def test_read_wire_golden(spark):
    w = read_wire(spark, GOLDEN)
    r = {x.id: x for x in w.collect()}
    assert set(r) == {"a1", "a2", "a3"}
    assert r["a1"].companies.company[0].titleCount == 2 and r["a1"].companies.company[0].primary is True
    assert r["a2"].source.feed.editorialTopics.editorialTopic == ["Sports", "Golf"]
    assert r["a1"].source.feed.id == 77
    assert read_wire_status(spark, GOLDEN).first().failed is False


def test_wire_to_article_golden(spark):
    w = read_wire(spark, GOLDEN)
    w = w.select(F.struct(*[c for c in w.columns if c not in ("_corrupt_record", "source_file")]).alias("a"))
    w = w.withColumn("seq", F.col("a.sequenceId").cast("bigint")).withColumn("xml", F.lit("<x/>"))
    feeds = spark.createDataFrame([("f77", "p77", 77)], "feed_id string, pub_id string, metabase_id bigint")
    new_pubs, new_feeds, links = wire.wire_parents(w, feeds, False, "2024-02-01 00:00:00")
    assert new_feeds.count() == 1 and new_pubs.first().name == "Feed 78"
    arts = {r.title: r for r in wire.wire_to_article(w, links, False, "2024-02-01 00:00:00").collect()}
    a1, a2, a3 = arts["First story"], arts["Second story"], arts["Third story"]
    assert a1.url == "http://orig.example.com/1" and a1.author == "Jane Roe" and a1.pub_id == "p77"
    assert a2.url == "http://www.example.com/view/LNI-42"          # item id link wins
    assert a2.published == dt.datetime(2014, 11, 21, 7, 30)        # bare date -> harvest date
    assert a3.published == dt.datetime(2024, 2, 1)                 # neither parses -> run time
    assert a1.has_empty_body and not a2.has_empty_body and a1.origin == "webnews"
    cur = wire.wire_cursor(w.withColumn("b", F.lit(1)).withColumn("pos", F.col("seq") * 0 + F.monotonically_increasing_id()), "b", "pos")
    assert cur.first().sequence_id == "950"                        # last in document order, not max


PAGE = (b"<html><head><title>T &amp; t</title><meta name='author' content='Ann'>"
        b"<script>var x='<p>no</p>';</script></head><body><nav>Menu <a>x</a></nav> tail"
        b"<h1> Big   Title </h1><time datetime='2024-01-02T03:04:05Z'>x</time>"
        b"<article><p>First paragraph has enough words to count.<br>Second line<p>Unclosed "
        b"paragraph with plenty of text to pass</article><span class='author'>By Bob</span></body></html>")


def test_content_extraction():
    c = _content(PAGE)
    assert c["title"] == "T & t" and c["authors"] == ["Ann"] and c["published"] == "2024-01-02T03:04:05Z"
    assert "First paragraph" in c["body_text"] and "Unclosed" in c["body_text"] and "no</p>" not in c["body_text"]
    assert c["body_xpath"] == "/html/body/article"
    assert _content(b"")["body_text"] == ""


def test_xpath_rules():
    r = _xpath_row(PAGE, ["-//nav", "//article"], ["//span[@class='author']"], ["//time~~%d"],
                   ["//h2", "normalize-space(//h1)"], "")
    assert r["title"] == "Big Title" and r["author"] == "By Bob" and r["body"].startswith("First paragraph")
    assert r["published"] == "x"
    # body rule with a body already present is not run
    assert _xpath_row(PAGE, ["//article"], [], [], [], "have body")["body"] is None
    assert _xpath_row(PAGE, [], [], [], ["//h2"], "")["title"] is None
    assert _xpath_row(PAGE, [], [], [], ["//h1/following::x"], "")["error"].startswith("Unsupported")


def test_fix_removed_node_keeps_tail():
    root = ht.parse_html(PAGE)
    ht.remove(root, "//nav")
    body = ht.select(root, "//body")[0]
    assert "tail" in body.text() and "Menu" not in body.text()


def test_wire_cursor_from_file(spark):
    from newsdesk.sources.wire import wire_cursor_from_files
    assert wire_cursor_from_files(spark, GOLDEN).first().sequence_id == "950"


def test_xpath_subset_forms():
    doc = ht.parse_html(b"<div class='a' id='x'><p>one</p><p>two</p></div><div class='a'><p>three</p></div>"
                        b"<meta property='article:published_time' content='2024-01-02'>")
    assert ht.evaluate(doc, "(//p)[3]") == "three"
    assert ht.evaluate(doc, "//div[@class='a' and @id='x']/p[2]") == "two"
    assert ht.evaluate(doc, "//div[contains(@class,'a')]//p") == "one"
    assert ht.evaluate(doc, "//meta[@property='article:published_time']/@content") == "2024-01-02"
    assert ht.evaluate(doc, "normalize-space(//div[2])") == "three"


def test_one_pass_page_extraction_matches_two_pass():
    from newsdesk.operators.extract import _page_row
    for rules in ((["-//nav", "//article"], ["//span[@class='author']"], ["//time~~%d"], ["normalize-space(//h1)"]),
                  ([], [], [], ["//h2", "//h1"]), ([], [], [], [])):
        one = _page_row(PAGE, *rules)
        assert one["content"] == _content(PAGE)
        two = _xpath_row(PAGE, *rules, _content(PAGE)["body_text"])
        assert one["xp"] == two
    assert _page_row(b"", [], [], [], [])["xp"]["error"] == "No HTML"


def test_failure_response_and_licensed_origin(spark, tmp_path):
    from newsdesk.sources.wire import read_wire_status
    bad = tmp_path / "fail.xml"
    bad.write_text("<response><status>FAILURE</status><messageCode>1001</messageCode>"
                   "<userMessage>bad key</userMessage></response>")
    st = read_wire_status(spark, str(bad)).first()
    assert st.failed is True and st.messageCode == "1001"
    assert read_wire(spark, str(bad)).count() == 0               # no articles in a failed response
    w = read_wire(spark, GOLDEN)
    w = w.select(F.struct(*[c for c in w.columns if c not in ("_corrupt_record", "source_file")]).alias("a"))
    w = w.withColumn("seq", F.col("a.sequenceId").cast("bigint"))
    feeds = spark.createDataFrame([], "feed_id string, pub_id string, metabase_id bigint")
    _p, new_feeds, links = wire.wire_parents(w, feeds, True, "2024-02-01 00:00:00")
    arts = wire.wire_to_article(w, links, True, "2024-02-01 00:00:00").collect()
    assert {a.origin for a in arts} == {"lexisnexis"} and all(a.is_lexisnexis for a in arts)
    assert {f.origin for f in new_feeds.collect()} == {"lexisnexis"}
