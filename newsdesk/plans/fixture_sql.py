"""DuckDB twins of ``newsdesk.sources.driver_tables`` (oracle side only).

Each constant is one CTE over the driver's views. ``with_views(sql)``
prefixes a query with all of them; DuckDB evaluates only those used.
"""

OID = "printf('%024x', {})"


def oid(x: str) -> str:
    return OID.format(x)


RFC1123 = "strftime({0}, '%a, %d %b %Y %H:%M:%S') || ' GMT'"
RFC3339 = "strftime({0}, '%Y-%m-%dT%H:%M:%S') || 'Z'"
TS = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
NOW = "TIMESTAMP '2024-01-30 12:00:00'"


def make_id(ts: str, *key: str) -> str:
    """8 hex of epoch seconds + 16 hex of sha256 of the \\x01-joined key."""
    k = ", ".join(f"coalesce(CAST({x} AS VARCHAR), '')" for x in key)
    return (f"(lpad(lower(hex(CAST(floor(epoch({ts})) AS BIGINT))), 8, '0') || "
            f"substr(sha256(concat_ws(chr(1), {k})), 1, 16))")


D_PUB = f"""d_pub AS (
  SELECT {oid('c_custkey')} AS pub_id,
    CAST(NULL AS BIGINT) AS metabase_id,
    CASE WHEN c_custkey % 250 = 0 THEN '' ELSE c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) END AS name,
    'http://www.' || lower(c_mktsegment) || '.example.com/' || CAST(c_custkey AS VARCHAR) AS homepage,
    lower(c_mktsegment) AS genre, c_name AS description, n_name AS country,
    0 AS num_articles, 0 AS num_feeds, CAST(c_custkey % 1000 AS INTEGER) AS num_readers,
    CASE WHEN c_custkey % 8 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN CAST([] AS VARCHAR[])
         ELSE [c_mktsegment, CASE WHEN c_custkey % 2 = 0 THEN 'Health Care' ELSE 'health care' END] END AS categories,
    CASE WHEN c_custkey % 5 = 0 THEN ['-//nav', '//article'] END AS xpath_body,
    CASE WHEN c_custkey % 6 = 0 THEN ['//span[@class=''author'']'] END AS xpath_author,
    CASE WHEN c_custkey % 7 = 0 THEN ['//time~~%Y-%m-%d'] END AS xpath_date,
    CASE WHEN c_custkey % 3 = 0 THEN ['//h1'] END AS xpath_title,
    TIMESTAMP '2020-01-01 00:00:00' + to_hours(CAST(c_custkey AS BIGINT)) AS added,
    c_custkey % 17 = 0 AS deleted
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

D_FEED = f"""d_feed_base AS (
  SELECT user_id, ts AS last_ts, event_type AS last_type, first_ts FROM (
    SELECT user_id, ts, event_type, min(ts) OVER (PARTITION BY user_id) AS first_ts,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM events) WHERE rn = 1),
d_feed AS (
  SELECT {oid('user_id')} AS feed_id, {oid('user_id * 10')} AS pub_id,
    CASE WHEN user_id % 10 = 0 THEN user_id END AS metabase_id,
    'http://feeds.example.com/' || CAST(user_id AS VARCHAR) || '.xml' AS url,
    CAST(NULL AS VARCHAR) AS original_url, 0 AS num_articles, 'rss' AS origin,
    CAST(NULL AS VARCHAR) AS etag, CAST(NULL AS VARCHAR) AS modified,
    CASE WHEN user_id % 11 = 0 THEN NULL WHEN last_type = 'error' THEN 1 ELSE 0 END AS bozo,
    CAST(NULL AS INTEGER) AS status,
    first_ts AS added, last_ts AS last_download,
    CASE WHEN user_id % 7 = 0 THEN NULL ELSE last_ts + INTERVAL 1 HOUR END AS next_download,
    CAST(NULL AS TIMESTAMP) AS updated,
    user_id % 13 = 0 AS deleted
  FROM d_feed_base)"""

STATUS = ("CASE event_type WHEN 'signup' THEN 301 WHEN 'view' THEN 304 WHEN 'click' THEN 200 "
          "WHEN 'error' THEN 410 ELSE NULL END")

D_POLL = f"""d_poll AS (
  SELECT {oid('user_id')} AS feed_id, ts AS fetched_at, {STATUS} AS status,
    CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS bozo,
    'http://feeds.example.com/' || CAST(user_id AS VARCHAR) || '/moved.xml' AS href,
    '"' || CAST(event_id AS VARCHAR) || '"' AS etag,
    {RFC1123.format('ts')} AS modified, ts AS updated, event_id, user_id
  FROM events),
d_entry AS (
  SELECT p.*, e.entry_pos, e.link, e.author FROM d_poll p,
  LATERAL (SELECT * FROM (VALUES
     (0, 'http://news.example.com/' || CAST(p.event_id % 5000 AS VARCHAR) || '/story', 'By Staff'),
     (1, 'http://news.example.com/' || CAST(p.event_id % 5000 AS VARCHAR) || '/story?utm_source=rss&id=' || CAST(p.event_id % 7 AS VARCHAR), 'Desk'),
     (2, CASE WHEN p.event_id % 10 <> 0 THEN 'http://news.example.com/' || CAST(p.event_id % 5000 AS VARCHAR) || '/story#c' END, 'Wire')
  ) AS t(entry_pos, link, author)) e)"""

D_ARTICLE = f"""d_article AS (
  SELECT {oid('o_orderkey')} AS article_id, {oid('o_custkey % 150')} AS feed_id,
    {oid('o_custkey')} AS pub_id,
    'http://a.example/' || CAST(o_orderkey % 12000 AS VARCHAR) AS url,
    'Order ' || CAST(o_orderkey AS VARCHAR) AS title,
    CASE WHEN o_orderkey % 3 = 0 THEN 'By By Clerk' ELSE 'Clerk' END AS author,
    CASE o_orderstatus WHEN 'F' THEN 'webnews' WHEN 'O' THEN 'lexisnexis' ELSE 'rss' END AS origin,
    o_orderpriority AS genre,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderdate END AS published,
    repeat('x', CAST(o_orderkey % 13 AS INTEGER)) AS body_text,
    o_orderkey % 13 = 0 AS has_empty_body,
    o_orderstatus = 'O' AS is_lexisnexis,
    o_orderdate + INTERVAL 1 DAY AS added,
    o_orderkey, o_custkey, o_orderstatus
  FROM orders)"""

D_LINKS = """d_links AS (
  SELECT page_id, url AS link FROM pages
  UNION ALL
  SELECT page_id + 1000000, url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END
         || 'utm_campaign=x&fbclid=1&CMP=a'
  FROM pages WHERE NOT contains(url, '#'))"""

D_WORK = f"""d_work AS (
  SELECT {oid('event_id')} AS article_id, {oid('user_id')} AS feed_id, {oid('user_id * 10')} AS pub_id,
    'http://news.example.com/' || CAST(event_id % 5000 AS VARCHAR) || '/story' AS link,
    event_type AS stage, ts AS started, ts AS last_action
  FROM events)"""

D_PAGE = f"""d_page AS (
  SELECT {oid('page_id')} AS article_id, {oid('page_id % 15')} AS feed_id,
    {oid('page_id % 150')} AS pub_id, url AS link,
    CASE WHEN page_id % 40 = 7 THEN '/moved/' || CAST(page_id AS VARCHAR) END AS location,
    CASE WHEN page_id % 50 = 0 THEN 'audio/mpeg' ELSE 'text/html' END AS content_type,
    CASE WHEN page_id % 45 = 0 THEN 0 ELSE octet_length(encode(html)) END AS n_bytes,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(page_id AS BIGINT)) AS fetched_at,
    page_id
  FROM pages)"""

D_TEXT = f"""d_text AS (
  SELECT {oid('doc_id')} AS article_id, source AS pub_id, source || '/' || lang AS feed_id,
    text AS body_text
  FROM documents)"""

D_WIRE = f"""d_wire AS (
  SELECT o_orderkey AS seq, 'w' || CAST(o_orderkey AS VARCHAR) AS wid,
    'Wire ' || CAST(o_orderkey AS VARCHAR) AS title,
    repeat('y', CAST(o_orderkey % 17 AS INTEGER)) AS content,
    CASE WHEN o_orderkey % 9 = 4 THEN '2014-11-20' ELSE {RFC3339.format('o_orderdate')} END AS published_date,
    o_orderdate AS published_ts,
    'http://wire.example.com/' || CAST(o_orderkey AS VARCHAR) AS url,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'http://orig.example.com/' || CAST(o_orderkey AS VARCHAR) END AS original_url,
    CASE WHEN o_orderkey % 5 = 0 THEN 'LNI-' || CAST(o_orderkey AS VARCHAR) END AS lni,
    CASE WHEN o_orderkey % 2 = 0 THEN 'By By ' || c_name ELSE c_name END AS author_name,
    n_name AS country, o_custkey % 50 AS wire_feed_id,
    'Wire feed ' || CAST(o_custkey % 50 AS VARCHAR) AS feed_name,
    o_orderpriority AS genre, c_mktsegment AS segment, o_custkey, o_orderstatus
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)"""

ALL = [D_PUB, D_FEED, D_POLL, D_ARTICLE, D_LINKS, D_WORK, D_PAGE, D_TEXT, D_WIRE]


def with_views(sql: str) -> str:
    return "WITH " + ",\n".join(ALL) + "\n" + sql
