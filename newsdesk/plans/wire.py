"""The newswire path as one batch stage, shared by the batch job and
``streaming.jobs.stream_wire``: parsed wire rows -> parents -> articles."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from newsdesk.operators import wire as w
from newsdesk.operators.tables import small


def position(wire_rows: DataFrame) -> str:
    """The column that orders a batch: the place in its documents, or the
    sequence number where the source carries no place."""
    return "pos" if "pos" in wire_rows.columns else "seq"


def ingest_wire(wire_rows: DataFrame, feeds: DataFrame, run_ts, is_lexisnexis: bool = False,
                a: str = "a", xml_col: str | None = None, batch_name: str = "batch", kept: bool = False):
    """(new_pubs, new_feeds, articles, cached). ``wire_rows`` has the parsed
    article struct in column ``a`` and an order column ``seq``; the rows feed
    both the parent resolution and the mapping, so they are persisted once
    (the caller unpersists ``cached`` after writing). With ``kept`` the caller
    has persisted them, and ``cached`` are the parents (a row for each wire
    feed), which three outputs share. The links are broadcast when they were
    measured as small, so that no exchange holds whole articles."""
    rows = wire_rows if kept else wire_rows.persist(StorageLevel.MEMORY_AND_DISK)
    new_pubs, new_feeds, links, parents = w.resolved_parents(rows, feeds, is_lexisnexis, run_ts, a=a, order=position(rows))
    if kept:
        parents.persist(StorageLevel.MEMORY_AND_DISK)
    articles = w.wire_to_article(rows, small(links), is_lexisnexis, run_ts, a=a, xml_col=xml_col,
                                 batch_name=batch_name)
    return new_pubs, new_feeds, articles, parents if kept else rows


def wire_rows_from_files(df: DataFrame) -> DataFrame:
    """Rows of the XML file source -> (a struct, seq, and pos where the rows
    have it), corrupt records out (``wire_rejects`` has them). ``seq`` is NULL
    for an id that is no number."""
    cols = [c for c in df.columns if c not in ("_corrupt_record", "source_file", "pos")]
    out = df
    if "_corrupt_record" in df.columns:
        out = out.filter(F.col("_corrupt_record").isNull())
    return (out.select(F.struct(*cols).alias("a"), *[c for c in ("pos",) if c in df.columns])
            .withColumn("seq", F.col("a.sequenceId").try_cast("bigint")))


def wire_rejects(df: DataFrame) -> DataFrame:
    """Records that the XML source could not read, as (record, reason)."""
    return (df.filter(F.col("_corrupt_record").isNotNull())
            .select(F.col("_corrupt_record").alias("record"), F.lit("Malformed article").alias("reason")))
