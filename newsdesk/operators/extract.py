"""Article extraction: page content (main text, title, authors, date) and
per-publication XPath rules.

Both run as struct-returning pandas UDFs in a narrow stage (no shuffle):
Arrow moves a batch of pages to a Python worker, the stdlib parser handles
each page, and the results come back as columns. Everything around them
(joins, precedence, date parsing) is Column code.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from newsdesk.functions import htmltree as ht
from newsdesk.functions.dates import parse_loose_date
from newsdesk.functions.text import nullif_empty

_STR = T.StringType()
CONTENT_SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("body_text", _STR), ("body_html", _STR), ("body_xpath", _STR), ("title", _STR),
    ("authors", T.ArrayType(_STR)), ("published", _STR))])
XPATH_SCHEMA = T.StructType([T.StructField(n, _STR) for n in
                             ("author", "body", "published", "title", "error")])
# elements that never hold the article body
NOISE = {"script", "style", "noscript", "nav", "header", "footer", "aside", "form", "iframe", "template"}
CANDIDATES = {"article", "main", "section", "div", "td", "body"}
MIN_PARAGRAPH = 20
DATE_META = {"article:published_time", "og:published_time", "date", "pubdate", "publishdate",
             "dc.date", "dc.date.issued", "sailthru.date"}


def _strip_noise(root: ht.Node) -> None:
    for n in list(root.iter()):
        if n.tag in NOISE and n.parent is not None:
            n.parent.children = [c for c in n.parent.children if c is not n]


def _paragraph_score(node: ht.Node) -> int:
    s = 0
    for c in node.elements():
        if c.tag == "p":
            t = len(ht.normalize_space(c.text()))
            if t >= MIN_PARAGRAPH:
                s += t
    return s


def _content(html, root: ht.Node | None = None) -> dict:
    """Content of one page; ``root`` is a parsed tree to reuse (it is
    changed: noise elements are removed)."""
    empty = {"body_text": "", "body_html": None, "body_xpath": None, "title": "",
             "authors": [], "published": None}
    if html is None or len(html) == 0:
        return empty
    root = ht.parse_html(html) if root is None else root
    out = dict(empty)
    metas = [n for n in root.iter() if n.tag == "meta"]
    t = next((n for n in root.iter() if n.tag == "title"), None)
    title = ht.normalize_space(t.text()) if t is not None else ""
    if not title:
        title = next((m.attrs.get("content") or "" for m in metas
                      if (m.attrs.get("property") or "").lower() == "og:title"), "")
    out["title"] = title
    authors = [m.attrs.get("content") for m in metas
               if (m.attrs.get("name") or "").lower() == "author" and m.attrs.get("content")]
    if not authors:
        for n in root.iter():
            cls = (n.attrs.get("class") or "") + " " + (n.attrs.get("rel") or "")
            if ("author" in cls or "byline" in cls) and n.tag not in ("meta", "link"):
                a = ht.normalize_space(n.text())
                if a:
                    authors.append(a)
                    break
    out["authors"] = authors
    pub = next((m.attrs.get("content") for m in metas
                if ((m.attrs.get("property") or m.attrs.get("name") or "").lower() in DATE_META)
                and m.attrs.get("content")), None)
    if pub is None:
        pub = next((n.attrs.get("datetime") for n in root.iter()
                    if n.tag == "time" and n.attrs.get("datetime")), None)
    out["published"] = pub
    _strip_noise(root)
    best, best_score = None, 0
    for n in root.iter():
        if n.tag in CANDIDATES:
            sc = _paragraph_score(n)
            if sc > best_score:
                best, best_score = n, sc
    if best is not None:
        paras = [ht.normalize_space(p.text()) for p in best.iter() if p.tag == "p"]
        out["body_text"] = "\n\n".join(p for p in paras if p)
        out["body_html"] = best.to_html()
        out["body_xpath"] = best.path()
    return out


@F.pandas_udf(CONTENT_SCHEMA)
def _content_udf(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_content(h) for h in html], columns=[
        "body_text", "body_html", "body_xpath", "title", "authors", "published"])


def extract_content(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Add ``goose``-style extraction results as column ``content``. Pages
    are expected to be validated already (size and type checks run first, so
    oversized bodies never reach Python)."""
    return pages.withColumn("content", _content_udf(F.col(html_col)))


def split_rules(rules) -> Column:
    """Split a rule list: ``-path`` rules remove nodes; any other rule is a
    search, cut at ``~~`` (a legacy date format suffix)."""
    r = rules if isinstance(rules, Column) else F.col(rules)
    removes = F.transform(F.filter(r, lambda x: x.startswith("-")), lambda x: F.right(x, F.length(x) - 1))
    searches = F.transform(F.filter(r, lambda x: ~x.startswith("-")), lambda x: F.substring_index(x, "~~", 1))
    return F.struct(removes.alias("removes"), searches.alias("searches"))


def _apply_rules(html, rules, shared=None) -> str | None:
    """First non-empty match of a rule list. Removal rules change the tree,
    so a list holding any gets a fresh parse; other lists read ``shared``."""
    if rules is None or len(rules) == 0:
        return None
    rules = list(rules)
    removes = [r[1:] for r in rules if r.startswith("-")]
    root = ht.parse_html(html) if removes or shared is None else shared
    for r in removes:
        ht.remove(root, r)
    for r in rules:
        if r.startswith("-"):
            continue
        v = ht.evaluate(root, r.split("~~", 1)[0])
        if v:
            return v
    return None


def _apply_lists(html, lists: dict, shared, out: dict) -> None:
    """Each list's first match; a rule that isn't supported ends its own list
    alone, and ``error`` names all of them."""
    for field, rules in lists.items():
        try:
            out[field] = _apply_rules(html, rules, shared)
        except ht.UnsupportedXPath as e:
            out["error"] = f"{out['error']}; {e}" if out["error"] else f"Unsupported XPath: {e}"


def _xpath_row(html, body_rules, author_rules, date_rules, title_rules, body_text) -> dict:
    out = {"author": None, "body": None, "published": None, "title": None, "error": None}
    if html is None or len(html) == 0:
        out["error"] = "No HTML"
        return out
    lists = [body_rules if not body_text else None, author_rules, date_rules, title_rules]
    if all(x is None or len(x) == 0 for x in lists):
        return out
    shared = ht.parse_html(html)
    rules = {"author": author_rules, "body": body_rules if not body_text else None, "published": date_rules, "title": title_rules}
    _apply_lists(html, rules, shared, out)
    return out


@F.pandas_udf(XPATH_SCHEMA)
def _xpath_udf(html: pd.Series, body: pd.Series, author: pd.Series, date: pd.Series,
               title: pd.Series, body_text: pd.Series) -> pd.DataFrame:
    rows = [_xpath_row(*args) for args in zip(html, body, author, date, title, body_text)]
    return pd.DataFrame(rows, columns=["author", "body", "published", "title", "error"])


def extract_xpath(articles: DataFrame, html_col: str = "html", body_col: str = "body_text") -> DataFrame:
    """Run the publication's rules (columns xpath_* from ``article_pub_rules``)
    on articles routed to ``xpath``; adds struct column ``xp``."""
    empty = F.array().cast("array<string>")
    return articles.withColumn("xp", _xpath_udf(
        F.col(html_col),
        F.coalesce("xpath_body", empty), F.coalesce("xpath_author", empty),
        F.coalesce("xpath_date", empty), F.coalesce("xpath_title", empty),
        F.coalesce(F.col(body_col), F.lit(""))))


PAGE_SCHEMA = T.StructType([T.StructField("content", CONTENT_SCHEMA), T.StructField("xp", XPATH_SCHEMA)])


def _page_row(html, body_rules, author_rules, date_rules, title_rules) -> dict:
    """Content and rules from one parse where possible: rule lists without
    removals read the tree before content extraction cleans it; lists with
    removals, and the body rule (only when no body was found), parse again."""
    xp = {"author": None, "body": None, "published": None, "title": None, "error": None}
    if html is None or len(html) == 0:
        xp["error"] = "No HTML"
        return {"content": _content(html), "xp": xp}
    root = ht.parse_html(html)
    _apply_lists(html, {"author": author_rules, "published": date_rules, "title": title_rules}, root, xp)
    content = _content(html, root)
    if not content["body_text"]:
        _apply_lists(html, {"body": body_rules}, None, xp)
    return {"content": content, "xp": xp}


@F.pandas_udf(PAGE_SCHEMA)
def _page_udf(html: pd.Series, body: pd.Series, author: pd.Series, date: pd.Series,
              title: pd.Series) -> pd.DataFrame:
    rows = [_page_row(*args) for args in zip(html, body, author, date, title)]
    return pd.DataFrame({"content": [r["content"] for r in rows], "xp": [r["xp"] for r in rows]})


def extract_page(articles: DataFrame, html_col: str = "html") -> DataFrame:
    """``extract_content`` and ``extract_xpath`` in one pass over the HTML
    (the article path's Python hot spot): adds ``content`` and ``xp``."""
    empty = F.array().cast("array<string>")
    r = _page_udf(F.col(html_col),
                  F.coalesce("xpath_body", empty), F.coalesce("xpath_author", empty),
                  F.coalesce("xpath_date", empty), F.coalesce("xpath_title", empty))
    return articles.withColumn("_page", r).withColumn("content", F.col("_page.content")) \
                   .withColumn("xp", F.col("_page.xp")).drop("_page")


def merge_extracted(df: DataFrame) -> DataFrame:
    """Precedence feed entry < page extraction < XPath rules for title,
    author and published; body from page extraction, XPath only when that
    is empty (and then body_html is cleared). Expects columns ``title``,
    ``author``, ``published`` (entry values), ``content`` and optionally
    ``xp``. Unparseable dates become NULL."""
    has_xp = "xp" in df.columns
    c = F.col("content")
    goose_pub = parse_loose_date(c["published"])
    title = F.coalesce(*( [nullif_empty(F.col("xp.title"))] if has_xp else []),
                       nullif_empty(c["title"]), F.col("title"))
    author = F.coalesce(*( [nullif_empty(F.col("xp.author"))] if has_xp else []),
                        nullif_empty(F.try_element_at(c["authors"], F.lit(1))), F.col("author"))
    published = F.coalesce(*( [parse_loose_date(F.col("xp.published"))] if has_xp else []),
                           goose_pub, F.col("published"))
    xp_body = nullif_empty(F.col("xp.body")) if has_xp else F.lit(None).cast("string")
    body_text = F.when(nullif_empty(c["body_text"]).isNull() & xp_body.isNotNull(), xp_body) \
                 .otherwise(F.coalesce(c["body_text"], F.lit("")))
    body_html = F.when(nullif_empty(c["body_text"]).isNull() & xp_body.isNotNull(), F.lit("")) \
                 .otherwise(c["body_html"])
    goose = F.struct(c["body_xpath"].alias("body_xpath"), c["title"].alias("title"),
                     goose_pub.alias("published"), c["authors"].alias("authors"))
    cols = [x for x in df.columns if x not in ("title", "author", "published", "body_text",
                                               "body_html", "content", "xp", "goose", "xpath")]
    extra = []
    if has_xp:
        extra.append(F.struct(nullif_empty(F.col("xp.title")).alias("title"),
                              nullif_empty(F.col("xp.author")).alias("author"),
                              parse_loose_date(F.col("xp.published")).alias("published")).alias("xpath"))
    return df.select(*cols, title.alias("title"), author.alias("author"), published.alias("published"),
                     body_text.alias("body_text"), body_html.alias("body_html"), goose.alias("goose"),
                     *extra)
