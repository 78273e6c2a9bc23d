"""Registered queries: one per operator, each over the driver's tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the operator on domain
tables derived from the driver data; ``ORACLE[name]`` is the same result in
DuckDB SQL over the driver's views. Outputs use plain types (timestamps as
``yyyy-MM-dd HH:mm:ss`` text, lists joined with ``|``) so both sides hash
alike.

The queries live in ``newsdesk.plans.queries`` (one module per group:
sources, updates, predicates, newswire, scalars, joins, aggregations,
catalogue, extraction (rows-only, brute-force tests instead of SQL),
flagship, streaming (inputs landed under the checkpoint folder, run with
availableNow), further inventory items, batch jobs) and register here on
import; shared fixture readers and SQL fragments are in ``plans.common``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsdesk.plans.fixture_sql import TS, with_views
from newsdesk.sources import driver_tables as dt

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

NOW = dt.NOW
RUN_TS = dt.RUN_TS


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return fn
    return deco


def ts_str(c) -> Column:
    c = c if isinstance(c, Column) else F.col(c)
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def ts_sql(c: str) -> str:
    return TS.format(c)


def joined(c) -> Column:
    c = c if isinstance(c, Column) else F.col(c)
    return F.array_join(c, "|")


# registration: each module adds its queries to QUERIES / ORACLE on import
from newsdesk.plans.queries import (  # noqa: E402,F401
    sources, updates, predicates, newswire, scalars, joins, aggregations, catalogue,
    extraction, flagship, streaming, more, jobs)
