"""Article path: page checks, routing, URL de-duplication, save."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsdesk.functions.ids import objectid_time
from newsdesk.functions.text import empty_body_flag, size0
from newsdesk.functions.urls import clean_url, resolve_url
from newsdesk.operators.tables import upsert

from newsdesk.fixed import BAD_CONTENT_TYPES, RSS_ORIGIN, SIZE_LIMIT, WIRE_ORIGINS
NO_PUB, DUPLICATE = "No pub found", "Article URL already exists"
RULE_COLS = ["xpath_body", "xpath_author", "xpath_date", "xpath_title"]


def page_validate(pages: DataFrame, size_limit: int = SIZE_LIMIT) -> DataFrame:
    """Add ``reject_reason``: refused content type, or a body that reached
    the size limit (the read is capped, so equal length is refused)."""
    n = F.coalesce(F.octet_length("html"), F.lit(0))
    reason = (F.when(F.col("content_type").isin(BAD_CONTENT_TYPES),
                     F.concat(F.lit("Invalid Content-Type: "), F.col("content_type")))
               .when(n >= size_limit, F.lit(f"Received more than {size_limit} bytes")))
    return pages.withColumn("reject_reason", reason)


def has_html(df: DataFrame) -> DataFrame:
    """Reject reason for rows without HTML (they would otherwise stall)."""
    return df.withColumn("reject_reason", F.coalesce(
        F.col("reject_reason") if "reject_reason" in df.columns else F.lit(None).cast("string"),
        F.when(F.coalesce(F.octet_length("html"), F.lit(0)) == 0, F.lit("No HTML"))))


def resolve_links(pages: DataFrame) -> DataFrame:
    """Final URL of each fetched page, cleaned of tracking parameters."""
    return pages.withColumn("url", clean_url(resolve_url(F.col("location"), F.col("link"))))


def origin_tag(is_wire=False, is_lexisnexis=False):
    """Origin of an article; the flags are booleans of a job or columns."""
    flag = lambda x: x if isinstance(x, Column) else F.lit(bool(x))
    return (F.when(flag(is_lexisnexis), F.lit(WIRE_ORIGINS[1]))
            .when(flag(is_wire), F.lit(WIRE_ORIGINS[0])).otherwise(F.lit(RSS_ORIGIN)))


def article_pub_rules(articles: DataFrame, pubs: DataFrame) -> DataFrame:
    """Attach each article's publication rules (left join on pub_id) and
    mark a missing publication as a reject.

    The pub table is a dimension (tens of thousands of rows); no broadcast
    hint: AQE turns the join into a broadcast once it has measured the
    pub side, and keeps the shuffle join when it is large."""
    rules = pubs.select("pub_id", *RULE_COLS, F.lit(True).alias("_pub_found"))
    j = articles.join(rules, "pub_id", "left")
    reason = F.when(F.col("_pub_found").isNull(), F.lit(NO_PUB))
    if "reject_reason" in articles.columns:
        reason = F.coalesce(F.col("reject_reason"), reason)
    return j.withColumn("reject_reason", reason).drop("_pub_found")


def pubs_with_rules(pubs: DataFrame) -> DataFrame:
    """The publications that have any rule: pub_id and the four lists."""
    return pubs.filter(" OR ".join(f"size({c}) > 0" for c in RULE_COLS)).select("pub_id", *RULE_COLS)


def extract_route(articles_with_rules: DataFrame) -> DataFrame:
    """``xpath`` when any of the four rule lists is non-empty, else ``save``."""
    any_rule = None
    for c in RULE_COLS:
        t = size0(c) > 0
        any_rule = t if any_rule is None else (any_rule | t)
    return articles_with_rules.withColumn(
        "route", F.when(any_rule, F.lit("xpath")).otherwise(F.lit("save")))


def published_fallback(articles: DataFrame) -> DataFrame:
    """A missing published time becomes the id's creation time."""
    return articles.withColumn("published",
                               F.coalesce(F.col("published"), objectid_time("article_id")))


def mark_empty_body(articles: DataFrame, min_bytes: int = 1) -> DataFrame:
    return articles.withColumn("has_empty_body", empty_body_flag("body_text", min_bytes))


def url_index(store: DataFrame) -> DataFrame:
    """Per url, the smallest and largest stored article id: one row per url,
    built by a partial aggregate, so a url stored a million times is still
    one row (no many-to-many join later)."""
    return (store.filter(F.col("url").isNotNull())
            .groupBy("url").agg(F.min("article_id").alias("_s_min"),
                                F.max("article_id").alias("_s_max")))


def judge_new_articles(articles: DataFrame, store: DataFrame) -> DataFrame:
    """The batch with ``reject_reason`` set on duplicates.

    An article is a duplicate when the store holds the same url under a
    different id (re-saving the same id is allowed), or when an earlier
    (smaller) id of the same batch carries the url. Both sides are reduced
    to one row per url first, so the joins never multiply rows, whatever
    the number of copies of a url.
    """
    batch_min = (articles.filter(F.col("url").isNotNull())
                 .groupBy("url").agg(F.min("article_id").alias("_b_min")))
    # only stored rows whose url occurs in the batch matter: the semi join
    # (the batch side is small and AQE broadcasts it) filters the store scan
    # before anything of the store is shuffled
    idx = url_index(store.select("url", "article_id").join(batch_min.select("url"), "url", "left_semi"))
    j = articles.join(idx, "url", "left").join(batch_min, "url", "left")
    a = F.col("article_id")
    other_in_store = F.col("_s_min").isNotNull() & ~((F.col("_s_min") == a) & (F.col("_s_max") == a))
    earlier_in_batch = F.col("_s_min").isNull() & F.col("_b_min").isNotNull() & (F.col("_b_min") < a)
    dup = F.coalesce(other_in_store | earlier_in_batch, F.lit(False))
    return (j.withColumn("reject_reason", F.when(dup, F.lit(DUPLICATE)))
             .drop("_s_min", "_s_max", "_b_min").select(*articles.columns, "reject_reason"))


def new_articles(articles: DataFrame, store: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a batch into (articles to save, duplicates with a reason).
    Callers writing both should persist the batch first."""
    j = judge_new_articles(articles, store)
    keep = j.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    rejects = j.filter(F.col("reject_reason").isNotNull())
    return keep, rejects


def upsert_articles(store: DataFrame, new: DataFrame) -> DataFrame:
    """Index each article under its own id (insert or replace)."""
    return upsert(store, new, "article_id")


def save_articles(store: DataFrame, batch: DataFrame, min_body_bytes: int = 1) -> tuple[DataFrame, DataFrame]:
    """The save stage: dedupe on url, published fallback, empty-body flag,
    upsert. Returns (new store, rejects)."""
    keep, rejects = new_articles(batch, store)
    keep = mark_empty_body(published_fallback(keep), min_body_bytes)
    return upsert_articles(store, keep), rejects
