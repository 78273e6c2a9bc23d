"""URL cleaning and resolution as pure Column expressions (JVM side, no Python).

``clean_url`` removes tracking parameters from a query string and re-encodes
what is left with keys in byte order, the way a URL query encoder does
(space as ``+``, unreserved ``A-Z a-z 0-9 - _ . ~`` kept, the rest %XX).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from newsdesk.fixed import BAD_KEYS, BAD_KEY_PREFIXES, BAD_KEY_SUBSTRING, BAD_PAIRS, BAD_VALUES
from newsdesk.functions._col import as_col, let


def query_decode(c: Column) -> Column:
    """Form decoding: ``+`` is a space, %XX a byte; NULL on a bad escape."""
    return F.try_url_decode(c)


def query_encode(c: Column) -> Column:
    """Form encoding with the unreserved set ``A-Z a-z 0-9 - _ . ~``.

    ``url_encode`` keeps ``*`` and escapes ``~``; both are put right here.
    """
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")),
                     F.lit("*"), F.lit("%2A"))


def _key_is_bad(k: Column, v: Column) -> Column:
    cond = k.isin(BAD_KEYS) | v.isin(BAD_VALUES) | k.contains(BAD_KEY_SUBSTRING)
    for p in BAD_KEY_PREFIXES:
        cond = cond | k.startswith(p)
    for bk, bv in BAD_PAIRS:
        cond = cond | ((k == bk) & (v == bv))
    return cond


def split_url(c) -> tuple[Column, Column, Column]:
    """(head, raw query, '#fragment' or ''): the fragment is cut first, then
    the query at the first '?'."""
    u = as_col(c)
    hpos = F.instr(u, "#")
    base = F.when(hpos > 0, F.substring(u, F.lit(1), hpos - 1)).otherwise(u)
    frag = F.when(hpos > 0, F.substring(u, hpos, F.length(u))).otherwise(F.lit(""))
    qpos = F.instr(base, "?")
    head = F.when(qpos > 0, F.substring(base, F.lit(1), qpos - 1)).otherwise(base)
    rawq = F.when(qpos > 0, F.substring(base, qpos + 1, F.length(base))).otherwise(F.lit(""))
    return head, rawq, frag


def query_pairs(rawq: Column) -> Column:
    """ARRAY<STRUCT<k, v, pos>> of decoded pairs. Empty parts and parts
    holding ';' are skipped; a pair whose key or value fails to decode is
    dropped, as a query parser does."""
    parts = F.split(rawq, "&")
    pairs = F.transform(parts, lambda p, i: F.struct(
        F.when(F.instr(p, "=") > 0, query_decode(F.substring_index(p, "=", 1)))
         .otherwise(query_decode(p)).alias("k"),
        F.when(F.instr(p, "=") > 0,
               query_decode(F.substring(p, F.instr(p, "=") + 1, F.length(p))))
         .otherwise(F.lit("")).alias("v"),
        i.alias("pos"),
        ((p != "") & ~p.contains(";")).alias("ok"),
    ))
    return F.filter(pairs, lambda q: q["ok"] & q["k"].isNotNull() & q["v"].isNotNull())


def clean_query(rawq: Column) -> Column:
    """Cleaned, re-encoded query string ('' when nothing is left)."""
    # the value tested is the first value of the key; all values of a bad key go
    # (a lookup within one URL's own parameters, a handful per row)
    first_v = lambda pairs, q: F.element_at(F.filter(pairs, lambda r: r["k"] == q["k"]), 1)["v"]
    kept = let(query_pairs(rawq), lambda pairs: F.filter(
        pairs, lambda q: let(first_v(pairs, q), lambda v: ~_key_is_bad(q["k"], v))))
    # keys in byte order, values of one key in input order
    ordered = F.array_sort(F.transform(kept, lambda q: F.struct(
        q["k"].alias("k"), q["pos"].alias("pos"), q["v"].alias("v"))))
    return F.array_join(F.transform(ordered, lambda q: F.concat(
        query_encode(q["k"]), F.lit("="), query_encode(q["v"]))), "&")


def clean_url(c) -> Column:
    """Drop tracking parameters; keep scheme, host, path and fragment."""
    def parts(u: Column) -> Column:
        head, rawq, frag = split_url(u)
        return F.when(u.isNotNull(), F.struct(head.alias("head"), rawq.alias("rawq"), frag.alias("frag")))

    def joined(p: Column) -> Column:
        # the scheme is case-insensitive and written in lower case, as a URL
        # parser does; host and path keep their case
        scheme = F.regexp_extract(p["head"], r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
        head = F.concat(F.lower(scheme), F.substring(p["head"], F.length(scheme) + 1, F.length(p["head"])))
        query = let(clean_query(p["rawq"]), lambda q: F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))
        return F.when(p.isNotNull(), F.concat(head, query, p["frag"]))

    return let(as_col(c), lambda u: let(parts(u), joined))


def _joined_path(path: Column) -> Column:
    """The path with ``.`` and ``..`` segments taken out."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1))))
                        .when(x == ".", acc).otherwise(F.concat(acc, F.array(x))))
    # a path that ends in a dot segment names a folder
    return F.concat(F.array_join(kept, "/"), F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit("")))


def resolve_url(location, link) -> Column:
    """Redirect target if the fetch left one, else the link. A relative
    target is made absolute against the link: its scheme, host, path or
    query, by what the target lacks."""
    loc, lnk = as_col(location), as_col(link)
    origin = F.regexp_extract(lnk, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(lnk, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.when(path.contains("/"), F.regexp_extract(path, r"^(.*/)", 1)).otherwise(F.lit("/"))
    rel_path, rest = F.regexp_extract(loc, r"^([^?#]*)", 1), F.regexp_extract(loc, r"^[^?#]*(.*)$", 1)
    absolute = (F.when(loc.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), loc)
                 .when(loc.startswith("//"), F.concat(F.substring_index(lnk, "//", 1), loc))
                 .when(loc.startswith("/"), F.concat(origin, loc))
                 .when(loc.startswith("?"), F.concat(origin, path, loc))
                 .when(loc.startswith("#"), F.concat(F.substring_index(lnk, "#", 1), loc))
                 .when(~loc.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(origin, _joined_path(F.concat(folder, rel_path)), rest)))
    return F.coalesce(F.when(loc != "", absolute), lnk)
