"""Small string rules on columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from newsdesk.functions._col import as_col


def clean_author(c) -> Column:
    """Strip a leading ``By `` at most twice (case-sensitive)."""
    return F.regexp_replace(as_col(c), r"^(By ){1,2}", "")


def category_slug(c) -> Column:
    """Id of a unique category: lower case, spaces to underscores."""
    return F.replace(F.lower(as_col(c)), F.lit(" "), F.lit("_"))


def category_key(c) -> Column:
    """Alias lookup key: all spaces removed."""
    return F.replace(as_col(c), F.lit(" "), F.lit(""))


def empty_body_flag(c, min_bytes: int = 1) -> Column:
    """True when the body has fewer than ``min_bytes`` UTF-8 bytes
    (rss: 1, i.e. empty; newswire: 10). Bytes, not characters."""
    return F.coalesce(F.octet_length(as_col(c)), F.lit(0)) < min_bytes


def size0(c) -> Column:
    """Array size with NULL counted as empty (a "missing" field)."""
    return F.coalesce(F.size(as_col(c)), F.lit(0))


def nullif_empty(c) -> Column:
    c = as_col(c)
    return F.when(c != "", c)
