"""The feed-article path as batch stages, shared by the batch job and the
streaming job (``streaming.jobs.stream_articles``).

landed polls -> readable polls -> entries -> new links -> page fetches ->
checks -> final URL -> content extraction -> publication rules -> merge ->
URL de-duplication -> save.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from newsdesk.functions.dates import parse_rfc1123
from newsdesk.operators import articles as art
from newsdesk.operators.extract import extract_page, merge_extracted
from newsdesk.operators.tables import dead_letter, small
from newsdesk.store import Scratch

ENTRY_COLS = ["title", "author", "published"]
ARTICLE_COLS = ["article_id", "feed_id", "pub_id", "url", "title", "author", "published",
                "body_text", "body_html", "origin", "entry", "goose", "xpath"]


def check_pages(pages: DataFrame, size_limit: int = art.SIZE_LIMIT) -> DataFrame:
    """Type, size and empty-body checks; sets ``reject_reason``. Runs before
    any Python so oversized or refused bodies never reach the UDFs."""
    return art.has_html(art.page_validate(pages, size_limit))


class Cached:
    """What a stage holds until its outputs are written: persisted frames and
    scratch folders. The caller lets them go."""

    def __init__(self, scratch: Scratch, *frames: DataFrame):
        self.scratch, self.frames = scratch, frames

    def unpersist(self) -> None:
        for f in self.frames:
            f.unpersist()
        self.scratch.remove()


def decide(checked: DataFrame, pubs: DataFrame, stored) -> tuple[DataFrame, Scratch]:
    """Each checked page (with ``url`` and ``reject_reason``) without its HTML,
    with the reason of a missing publication or of a URL that is already saved.
    ``stored`` has the saved (article_id, url), or maps the batch's urls to
    those of them that are saved. Second, the written rows it reads."""
    known = pubs.select("pub_id", F.lit(True).alias("_known")).distinct()
    narrow = Scratch(checked.drop("html").join(known, "pub_id", "left")
                     .withColumn("reject_reason", F.coalesce("reject_reason", F.when(F.col("_known").isNull(), F.lit(art.NO_PUB))))
                     .drop("_known"))
    p = narrow.rows
    found = p.filter(F.col("reject_reason").isNull()).select("article_id", "url")
    urls = stored(found.select("url")) if callable(stored) else stored.select("article_id", "url")
    dups = (art.judge_new_articles(found, urls).filter(F.col("reject_reason").isNotNull())
            .select("article_id", "url", F.col("reject_reason").alias("_dup")).distinct())
    out = (p.join(dups, ["article_id", "url"], "left")
           .withColumn("reject_reason", F.coalesce("reject_reason", "_dup")).drop("_dup"))
    return out.select(*p.columns), narrow


def extract_articles(pages_ok: DataFrame, pubs: DataFrame) -> DataFrame:
    """Checked pages -> what extraction and the publication's rules found in
    them, without the HTML. One pass of Python over each page in the task that
    reads it; the rules come to the pages (broadcast when measured small)."""
    ruled = art.article_pub_rules(pages_ok, small(art.pubs_with_rules(pubs)))
    return extract_page(ruled).drop("html", "reject_reason", *art.RULE_COLS)


def process_pages(pages: DataFrame, pubs: DataFrame, stored, size_limit: int = art.SIZE_LIMIT,
                  said: DataFrame | None = None) -> tuple[DataFrame, DataFrame, Cached]:
    """(articles to save, rejects, cached frames). HTML is in no exchange: it is
    read for the checks and for extraction, and all decisions are made on ids
    and urls. ``said`` (article_id, title, author, published) is what the feed
    entries said, for pages that don't carry it."""
    checked = check_pages(art.resolve_links(pages), size_limit)
    decided, narrow = decide(checked, pubs, stored)
    decided = decided.persist(StorageLevel.MEMORY_AND_DISK)
    ok, _ = dead_letter(checked)
    # persisted before any join, so that no join moves below the extraction
    pages_read = extract_articles(ok, pubs).persist(StorageLevel.MEMORY_AND_DISK)
    keep = decided.filter(F.col("reject_reason").isNull()).select("article_id", "url").distinct()
    found = pages_read.join(keep, ["article_id", "url"], "left_semi")
    if said is not None:
        s = said.select("article_id", *[F.col(c).alias(f"_s_{c}") for c in ENTRY_COLS])
        found = found.join(s, "article_id", "left").select(
            *[F.coalesce(c, f"_s_{c}").alias(c) if c in ENTRY_COLS else F.col(c) for c in found.columns])
    # what the feed entry said, kept next to what extraction decides
    found = found.withColumn("published", parse_rfc1123("published")).withColumn(
        "entry", F.struct(F.col("link").alias("url"), *ENTRY_COLS))
    arts = merge_extracted(found).withColumn("origin", art.origin_tag()).select(*ARTICLE_COLS)
    articles = art.mark_empty_body(art.published_fallback(arts))
    bad = decided.filter(F.col("reject_reason").isNotNull())
    rejects = bad.select(
        "article_id", "feed_id", "pub_id", F.when(F.col("reject_reason") == art.DUPLICATE, F.col("url")).otherwise(F.col("link")).alias("link"),
        F.col("fetched_at").alias("started"), *ENTRY_COLS, F.col("reject_reason").alias("reason"))
    return articles, rejects, Cached(narrow, pages_read, decided)
