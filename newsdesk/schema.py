"""Explicit schemas of the domain tables (no inference anywhere).

Feeds and pubs hold the union of declared and dynamically added fields.
Zero times ("never") are NULL here.
"""

from pyspark.sql import types as T

S, L, I, B, TS, BIN = (T.StringType(), T.LongType(), T.IntegerType(),
                       T.BooleanType(), T.TimestampType(), T.BinaryType())
STRS = T.ArrayType(T.StringType())


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


PUB = _st(
    ("pub_id", S), ("metabase_id", L), ("name", S), ("homepage", S),
    ("genre", S), ("description", S), ("country", S),
    ("num_articles", I), ("num_feeds", I), ("num_readers", I),
    ("categories", STRS), ("xpath_body", STRS), ("xpath_author", STRS),
    ("xpath_date", STRS), ("xpath_title", STRS),
    ("last_update", TS), ("added", TS), ("is_new", B), ("deleted", B),
)

FEED = _st(
    ("feed_id", S), ("pub_id", S), ("metabase_id", L), ("url", S),
    ("original_url", S), ("num_articles", I), ("origin", S), ("genre", S),
    ("etag", S), ("modified", S), ("bozo", I), ("status", I),
    ("added", TS), ("last_download", TS), ("next_download", TS),
    ("updated", TS), ("deleted", B),
)

ENTRY = _st(("url", S), ("title", S), ("author", S), ("published", TS))
GOOSE = _st(("body_xpath", S), ("title", S), ("published", TS), ("authors", STRS))
XPATH = _st(("title", S), ("author", S), ("published", TS))
METABASE = _st(
    ("author", S), ("author_home_url", S), ("author_email", S),
    ("sequence_id", S), ("id", S), ("lni", S), ("published_date", S),
    ("harvest_date", S), ("embargo_date", S), ("license_end_date", S),
    ("content_license_end_date", S), ("url", S), ("original_url", S),
)

ARTICLE = _st(
    ("article_id", S), ("feed_id", S), ("pub_id", S), ("batch_id", S),
    ("url", S), ("title", S), ("author", S), ("origin", S), ("genre", S),
    ("published", TS), ("body_text", S), ("body_html", S), ("html", BIN),
    ("load_time", L), ("has_empty_body", B), ("is_lexisnexis", B),
    ("added", TS), ("entry", ENTRY), ("goose", GOOSE), ("xpath", XPATH),
    ("metabase", METABASE),
)

POLL_ENTRY = _st(("link", S), ("author", S), ("title", S), ("published", S))
FEED_POLL = _st(
    ("feed_id", S), ("fetched_at", TS), ("status", I), ("bozo", I),
    ("href", S), ("etag", S), ("modified", S), ("updated", TS),
    ("entries", T.ArrayType(POLL_ENTRY)),
)

PAGE_FETCH = _st(
    ("article_id", S), ("feed_id", S), ("pub_id", S), ("link", S),
    ("location", S), ("content_type", S), ("html", BIN), ("fetched_at", TS),
    ("author", S), ("title", S), ("published", S),
)

WORK = _st(
    ("article_id", S), ("feed_id", S), ("pub_id", S), ("link", S),
    ("stage", S), ("started", TS), ("last_action", TS),
    # what the feed entry said, for the article made of it
    ("title", S), ("author", S), ("published", S),
)

REJECT = _st(*[(f.name, f.dataType) for f in WORK.fields],
             ("added", TS), ("reason", S), ("data", S))   # data: the text of a record that can't be read

CATEGORY_ALIAS = _st(("alias", S), ("categories", STRS))
CATEGORY_UNIQUE = _st(("category_id", S), ("category", S), ("added", TS))
ARTICLE_COUNT = _st(("type", S), ("id", S), ("n", L))

# Legacy catalogue dump: publications with nested feeds.
LEGACY_PUB = _st(
    ("ID", S), ("Title", S), ("URL", S), ("NumArticles", I), ("NumFeeds", I),
    ("NumReaders", I), ("Updated", TS),
    ("XPaths", _st(("Author", STRS), ("Body", STRS), ("Date", STRS), ("Title", STRS))),
    ("Feeds", T.ArrayType(_st(("ID", S), ("URL", S), ("Updated", TS)))),
)
