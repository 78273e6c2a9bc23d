"""Date parsing as Column expressions (UTC session assumed).

All parsers return NULL for "no date" instead of a year-1 zero time.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from newsdesk.functions._col import as_col

# Patterns tried in order by the lenient parser (first match wins).
LOOSE_PATTERNS = [
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mmXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd",
    "dd MMM yyyy HH:mm:ss Z", "dd MMM yyyy HH:mm:ss", "dd MMM yyyy",
    "d MMM yyyy", "MMM d, yyyy HH:mm", "MMM d, yyyy", "MMMM d, yyyy",
    "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy", "yyyyMMdd'T'HHmmssZ",
    "yyyy-MM-dd'T'HH:mm:ssZ", "yyyy-MM-dd'T'HH:mm:ss.SSSZ", "yyyy-MM-dd HH:mm:ss Z", "yyyy-MM-dd HH:mm Z",
    "d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss", "d MMM yyyy HH:mm", "d MMMM yyyy HH:mm:ss", "d MMMM yyyy HH:mm", "d MMMM yyyy",
    "MMM d, yyyy HH:mm:ss", "MMM d, yyyy h:mm a", "MMMM d, yyyy HH:mm:ss", "MMMM d, yyyy HH:mm", "MMMM d, yyyy h:mm a",
]


def _strip_weekday(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"^[A-Za-z]{3,9},\s*", "")


def parse_rfc1123(c) -> Column:
    """``Mon, 02 Jan 2006 15:04:05 MST`` (zone name) or with a numeric
    offset (``-0700``). NULL when neither fits."""
    s = _strip_weekday(as_col(c))
    shape = r"^\d{2} [A-Z][a-z]{2} \d{4} \d{2}:\d{2}:\d{2} "
    body = F.regexp_extract(s, r"^(\d{2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}) ", 1)
    zone = F.regexp_extract(s, r" ([A-Za-z]+|[+-]\d{4})$", 1)
    # a zone name carries no offset for a parser running in UTC: offset 0
    offset = F.when(zone.rlike(r"^[+-]\d{4}$"), zone).otherwise(F.lit("+0000"))
    ts = F.try_to_timestamp(F.concat(body, F.lit(" "), offset),
                            F.lit("dd MMM yyyy HH:mm:ss Z"))
    return F.when(s.rlike(shape + r"([A-Za-z]+|[+-]\d{4})$"), ts)


_RFC3339 = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"


def parse_rfc3339_strict(c) -> Column:
    """Full RFC 3339 date-time; a bare date or a missing zone gives NULL."""
    s = as_col(c)
    return F.when(s.rlike(_RFC3339),
                  F.try_to_timestamp(F.upper(s), F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]XXX")))


def parse_rfc3339(published, harvest, run_ts) -> Column:
    """Published date, else harvest date, else the run time."""
    return F.coalesce(parse_rfc3339_strict(published), parse_rfc3339_strict(harvest),
                      as_col(run_ts) if not isinstance(run_ts, str) else F.lit(run_ts).cast("timestamp"))


def parse_loose_date(c) -> Column:
    """Lenient parse over a fixed list of patterns; dates without a zone are
    UTC. NULL when nothing fits (the raw text is never kept)."""
    s = _strip_weekday(as_col(c))
    s = F.regexp_replace(s, r"\s+(UTC|GMT|UT|Z)$", " +0000")
    tries = [F.try_to_timestamp(s, F.lit(p)) for p in LOOSE_PATTERNS]
    return F.coalesce(*tries, parse_rfc1123(c))


def format_rfc1123(c) -> Column:
    """``Mon, 02 Jan 2006 15:04:05 GMT`` in the UTC session."""
    return F.concat(F.date_format(as_col(c), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))


def format_rfc3339(c) -> Column:
    return F.date_format(as_col(c), "yyyy-MM-dd'T'HH:mm:ssXXX")


def not_zero_time(c) -> Column:
    """Year-1 "zero" times become NULL."""
    c = as_col(c)
    return F.when(F.year(c) > 1, c)
