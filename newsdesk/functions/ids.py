"""24-hex object ids: validity, embedded time, deterministic creation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from newsdesk.functions._col import as_col


def is_object_id(c) -> Column:
    """24 hex characters, either case."""
    return F.coalesce(as_col(c).rlike("^[0-9a-fA-F]{24}$"), F.lit(False))


def objectid_time(c) -> Column:
    """Creation time held in the first 8 hex digits (epoch seconds)."""
    c = as_col(c)
    secs = F.conv(F.substring(c, 1, 8), 16, 10).cast("bigint")
    return F.when(is_object_id(c), F.timestamp_seconds(secs))


def id_from_number(c) -> Column:
    """`%024x` of a non-negative number: string order equals number order."""
    return F.format_string("%024x", as_col(c).cast("bigint"))


def make_id(event_time, *natural_key) -> Column:
    """Deterministic replacement for random ids: 8 hex digits of the event
    time, then 16 hex digits of a hash of the natural key. A retry of the same
    input yields the same id, so writes stay idempotent."""
    secs = F.unix_timestamp(as_col(event_time)).cast("bigint")
    key = F.concat_ws("\u0001", *[F.coalesce(as_col(k).cast("string"), F.lit(""))
                                  for k in natural_key])
    return F.concat(F.lpad(F.lower(F.hex(secs)), 8, "0"),
                    F.substring(F.sha2(key, 256), 1, 16))
