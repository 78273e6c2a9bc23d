"""Shared pieces of the registered queries: fixture readers, landed inputs
and the SQL fragments several oracles use."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsdesk import fixed
from newsdesk.functions import dates, ids
from newsdesk.operators import articles as art
from newsdesk.operators import feeds, wire
from newsdesk.plans.fixture_sql import make_id as sql_make_id, with_views
from newsdesk.sources import driver_tables as dt
from newsdesk.sources.wire import render_wire

RUN_TS = dt.RUN_TS


def _id_requests(spark, d) -> DataFrame:
    """Id strings as a caller would send them, good and bad, from events."""
    ev = dt.read(spark, d, "events")
    u = F.col("user_id")
    t = F.col("event_type")
    s = (F.when(t == "click", ids.id_from_number(u))
          .when(t == "view", F.upper(ids.id_from_number(u)))
          .when(t == "error", F.format_string("%023x", u))
          .otherwise(F.concat(F.lit("g"), F.format_string("%023x", u))))
    return ev.select(F.col("event_id"), s.alias("id"))


_ID_REQ_SQL = """d_req AS (SELECT event_id, CASE event_type
    WHEN 'click' THEN printf('%024x', user_id) WHEN 'view' THEN upper(printf('%024x', user_id))
    WHEN 'error' THEN printf('%023x', user_id) ELSE 'g' || printf('%023x', user_id) END AS id FROM events)"""


_LANDED: dict = {}


#: Articles of a landed response file: one API page, so that the files, and
#: with them the tasks that read them, grow in number with the articles.
WIRE_PAGE = 500


def _wire_files(spark, d) -> str:
    """The newswire fixture (orders ⋈ customer ⋈ nation) landed as XML
    response files of one API page each, in sequence order, once per session
    and scale factor: the queries then read it the way newswire batches arrive
    (as files, through the XML source). The exchange and the sort hold narrow
    rows, the articles are made where they are written, and a response is
    landed as it is sent, compressed."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _LANDED:
        path = _run_dir(spark, "wire_xml")
        w = dt.wire_orders(spark, d).repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey")
        (dt.wire_articles_of(w).select("article.*")
          .write.format("xml").option("rowTag", "article").option("rootTag", "articles")
          .option("maxRecordsPerFile", WIRE_PAGE).option("compression", "gzip").save(path))
        _LANDED[key] = path
    return _LANDED[key]


def _wire(spark, d, mapped: bool = True) -> DataFrame:
    """Parsed newswire rows (struct ``a``, order ``seq``) read from the
    landed files; mapping paths read only the fields they use."""
    from newsdesk.plans.wire import wire_rows_from_files
    from newsdesk.sources.wire import read_wire
    return wire_rows_from_files(read_wire(spark, _wire_files(spark, d), with_file=False, mapped=mapped))


def _store_and_new(spark, d):
    """The whole article table as store; a change for each of its rows: a third
    of them saved again with another title, the others as articles of new ids."""
    a = dt.articles(spark, d)
    k = F.conv(F.col("article_id"), 16, 10).cast("bigint")
    new = (a.withColumn("title", F.concat("title", F.when(k % 3 == 0, F.lit(" (v2)")).otherwise(F.lit(" (new)"))))
           .withColumn("article_id", F.when(k % 3 == 0, F.col("article_id")).otherwise(ids.id_from_number(k + 1000000000))))
    return a, new


_LATEST_POLL_SQL = """d_last_poll AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feed_id ORDER BY fetched_at DESC, event_id) AS rn
                 FROM d_poll) WHERE rn = 1)"""


def _new_entries(spark, d) -> DataFrame:
    return feeds.entry_ids(feeds.entries_with_link(feeds.feed_entries(dt.feed_polls(spark, d))))


_ENTRY_ROWS_SQL = f"""d_entry_rows AS (
  SELECT *, {sql_make_id('fetched_at', 'feed_id', 'link')} AS article_id
  FROM d_entry WHERE coalesce(status, 500) NOT IN (304, 410, 500) AND link IS NOT NULL)"""


_DUP_SQL = """d_dups AS (
  SELECT p.pub_id AS old_id, s.new_id, p.name FROM d_pub p JOIN (
    SELECT name, min(pub_id) AS new_id FROM d_pub GROUP BY name HAVING count(*) > 1) s
  ON p.name = s.name WHERE p.pub_id <> s.new_id)"""


SMALL_PAGE_LIMIT = 4096


_REASON_SQL = f"""CASE WHEN content_type = 'audio/mpeg' THEN 'Invalid Content-Type: audio/mpeg'
       WHEN n_bytes >= {SMALL_PAGE_LIMIT} THEN 'Received more than {SMALL_PAGE_LIMIT} bytes' END"""


_ROUTE_SQL = """
SELECT g.article_id, g.pub_id,
  CASE WHEN coalesce(len(p.xpath_body), 0) > 0 OR coalesce(len(p.xpath_author), 0) > 0
         OR coalesce(len(p.xpath_date), 0) > 0 OR coalesce(len(p.xpath_title), 0) > 0
       THEN 'xpath' ELSE 'save' END AS route,
  CASE WHEN p.pub_id IS NULL THEN 'No pub found' END AS reject_reason
FROM d_page g LEFT JOIN d_pub p ON g.pub_id = p.pub_id"""


def _wire_links(spark, d, w=None):
    w = _wire(spark, d) if w is None else w
    return wire.wire_parents(w, dt.feeds(spark, d), False, RUN_TS)


_LINKS_SQL = f"""d_wire_ids AS (SELECT DISTINCT wire_feed_id AS metabase_id FROM d_wire),
d_known AS (SELECT metabase_id, min(feed_id) AS feed_id, min_by(pub_id, feed_id) AS pub_id
            FROM d_feed WHERE metabase_id IS NOT NULL GROUP BY metabase_id),
d_wire_links AS (
  SELECT i.metabase_id,
    coalesce(k.pub_id, {sql_make_id(f"TIMESTAMP '{RUN_TS}'", "'pub'", 'i.metabase_id')}) AS pub_id,
    coalesce(k.feed_id, {sql_make_id(f"TIMESTAMP '{RUN_TS}'", "'feed'", 'i.metabase_id')}) AS feed_id,
    k.feed_id IS NULL AS created
  FROM d_wire_ids i LEFT JOIN d_known k ON i.metabase_id = k.metabase_id)"""


_WIRE_URL_SQL = "coalesce('http://www.example.com/view/' || lni, original_url, url)"


def _q_encode(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def _q_decode(x: str) -> str:
    return f"url_decode(replace({x}, '+', ' '))"


_BAD_KEYS_SQL = ", ".join("'" + k + "'" for k in fixed.BAD_KEYS)


_CLEAN_URL_SQL = f"""d_split AS (
  SELECT page_id, link,
    CASE WHEN strpos(link, '#') > 0 THEN substr(link, 1, strpos(link, '#') - 1) ELSE link END AS base,
    CASE WHEN strpos(link, '#') > 0 THEN substr(link, strpos(link, '#')) ELSE '' END AS frag
  FROM d_links),
d_parts AS (
  SELECT page_id, link, frag,
    lower(regexp_extract(CASE WHEN strpos(base, '?') > 0 THEN substr(base, 1, strpos(base, '?') - 1) ELSE base END,
                         '^([A-Za-z][A-Za-z0-9+.-]*):', 1))
    || substr(CASE WHEN strpos(base, '?') > 0 THEN substr(base, 1, strpos(base, '?') - 1) ELSE base END,
              length(regexp_extract(base, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) + 1) AS head,
    CASE WHEN strpos(base, '?') > 0 THEN substr(base, strpos(base, '?') + 1) ELSE '' END AS rawq
  FROM d_split),
d_pairs AS (
  SELECT page_id, u.pos, u.p,
    {_q_decode("CASE WHEN strpos(u.p, '=') > 0 THEN substr(u.p, 1, strpos(u.p, '=') - 1) ELSE u.p END")} AS k,
    CASE WHEN strpos(u.p, '=') > 0 THEN {_q_decode("substr(u.p, strpos(u.p, '=') + 1)")} ELSE '' END AS v
  FROM d_parts, LATERAL (SELECT unnest(string_split(rawq, '&')) AS p, generate_subscripts(string_split(rawq, '&'), 1) AS pos) u
  WHERE u.p <> '' AND NOT contains(u.p, ';')),
d_first AS (SELECT page_id, k, arg_min(v, pos) AS fv FROM d_pairs GROUP BY page_id, k),
d_kept AS (
  SELECT p.page_id, p.k, p.v, p.pos FROM d_pairs p JOIN d_first f ON p.page_id = f.page_id AND p.k = f.k
  WHERE NOT (p.k IN ({_BAD_KEYS_SQL}) OR f.fv = 'rss' OR contains(p.k, '.99')
    OR starts_with(p.k, 'utm_') OR starts_with(p.k, 'fb') OR starts_with(p.k, 'atc')
    OR (p.k = 'ref' AND f.fv = '25') OR (p.k = 'ana' AND f.fv = 'RSS')
    OR (p.k = 's' AND f.fv = 'article_search') OR (p.k = 'attr' AND f.fv = 'all'))),
d_q AS (
  SELECT page_id, string_agg({_q_encode('k')} || '=' || {_q_encode('v')}, '&' ORDER BY k, pos) AS q
  FROM d_kept GROUP BY page_id),
d_clean AS (
  SELECT s.page_id, s.link,
    s.head || CASE WHEN coalesce(q.q, '') <> '' THEN '?' || q.q ELSE '' END || s.frag AS clean
  FROM d_parts s LEFT JOIN d_q q ON s.page_id = q.page_id)"""


def _loose_strings(spark, d) -> DataFrame:
    ev = dt.read(spark, d, "events")
    e, ts = F.col("event_id"), F.col("ts")
    s = (F.when(e % 6 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
          .when(e % 6 == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
          .when(e % 6 == 2, F.date_format(ts, "dd MMM yyyy"))
          .when(e % 6 == 3, F.date_format(ts, "MM/dd/yyyy"))
          .when(e % 6 == 4, dates.format_rfc1123(ts))
          .otherwise(F.lit("sometime soon")))
    return ev.select("event_id", s.alias("s"))


def _alias_sql() -> str:
    rows = ", ".join(f"('{a}', '{c.replace(' ', '')}')" for a, cats in fixed.CATEGORY_ALIASES for c in cats)
    return with_views(f"""
, d_alias(alias, key) AS (VALUES {rows}),
d_pc AS (SELECT pub_id, unnest(categories) AS category FROM d_pub)
SELECT p.pub_id, p.category, a.alias FROM d_pc p JOIN d_alias a ON replace(p.category, ' ', '') = a.key""")


def _wire_articles(spark, d) -> DataFrame:
    """Articles carrying their newswire XML (from orders), landed once per
    session as a parquet table, as stored articles are."""
    key = (spark.sparkContext.applicationId, d, "wire_articles")
    if key not in _LANDED:
        w = dt.wire_rows(spark, d).select("order_key", render_wire(F.col("article")).alias("xml"))
        a = dt.articles(spark, d).withColumn("_k", F.conv("article_id", 16, 10).cast("bigint"))
        out = (a.drop("html").join(w, F.col("_k") == F.col("order_key"), "inner")
               .withColumn("html", F.encode("xml", "UTF-8")).drop("_k", "order_key", "xml"))
        path = _run_dir(spark, "wire_articles")
        out.write.parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


_COUNTS_SQL = """SELECT type, id, count(*) AS n FROM (
  SELECT 'pub' AS type, pub_id AS id FROM d_article UNION ALL SELECT 'feed', feed_id FROM d_article)
GROUP BY type, id"""


QUEUE_THRESHOLD = 2000


def _pages_with_rules(spark, d) -> DataFrame:
    p = art.has_html(art.page_validate(dt.page_fetches(spark, d)))
    p = p.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return art.extract_route(art.article_pub_rules(p, dt.pubs(spark, d))).drop("reject_reason")


def _legacy_dump(spark, d) -> str:
    """Land the legacy catalogue dump (JSON lines) derived from customer:
    pub k lists k % 4 feeds."""
    import uuid
    from newsdesk.session import checkpoint_dir
    c = dt.read(spark, d, "customer")
    k = F.col("c_custkey")
    feeds_arr = F.transform(F.sequence(F.lit(0), (k % 4).cast("int") - 1),
                            lambda i: F.struct(
                                F.upper(F.concat(F.lpad(F.hex(F.lit(1262304000) + k), 8, "0"),
                                                 F.format_string("%016x", k * 4 + i))).alias("ID"),
                                F.concat(F.lit("http://legacy.example.com/"), k.cast("string"),
                                         F.lit("/"), i.cast("string"), F.lit(".xml")).alias("URL"),
                                F.lit(None).cast("timestamp").alias("Updated")))
    rows = c.select(
        F.upper(F.concat(F.lpad(F.hex(F.lit(1262304000) + k), 8, "0"), F.format_string("%016x", k))).alias("ID"),
        F.col("c_name").alias("Title"),
        F.concat(F.lit("http://legacy.example.com/"), k.cast("string")).alias("URL"),
        (k % 1000).cast("int").alias("NumReaders"),
        F.struct(F.when(k % 3 == 0, F.array(F.lit("//h1"))).alias("Title"),
                 F.lit(None).cast("array<string>").alias("Author"),
                 F.lit(None).cast("array<string>").alias("Body"),
                 F.lit(None).cast("array<string>").alias("Date")).alias("XPaths"),
        F.when(k % 4 > 0, feeds_arr).alias("Feeds"))
    path = checkpoint_dir(spark, "runs", uuid.uuid4().hex, "legacy")
    rows.write.json(path)
    return path


def _run_dir(spark, name):
    import uuid
    from newsdesk.session import checkpoint_dir
    return checkpoint_dir(spark, "runs", uuid.uuid4().hex, name)


def _land(df: DataFrame, path: str, order_col: str) -> None:
    """Land an input in ``order_col`` order (arrival order), in files whose
    number follows its size (the session's advisory partition size)."""
    df.repartitionByRange(order_col).sortWithinPartitions(order_col).write.parquet(path)


def _job_store(spark, d):
    """A fresh table store holding the fixture's pubs and feeds."""
    from newsdesk import schema as S
    from newsdesk.plans import jobs
    from newsdesk.store import TableStore
    store = TableStore(spark, _run_dir(spark, "tables"))
    store.write("pubs", jobs.conform(dt.pubs(spark, d), S.PUB))
    store.write("feeds", jobs.conform(dt.feeds(spark, d), S.FEED))
    return store
