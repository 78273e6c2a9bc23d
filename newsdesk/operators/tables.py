"""Set-based table updates: upsert, partial update, insert-ignore, delete.

Each takes the current table and a change set and returns the new table;
the caller writes it as a new snapshot (see ``newsdesk.store``). Replays
give the same result, so a retried task or batch is harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsdesk.functions.ids import is_object_id


#: Most bytes of a side that is broadcast on request (the driver holds it once).
BROADCAST_BYTES = 64 * 2 ** 20


def small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it was measured at ``most`` bytes or
    fewer (its rows as JSON text), else as it is: the join shuffles then."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))).cast("long"))).first()[0]
    return F.broadcast(df) if (size or 0) <= most else df


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def dedupe_first(df: DataFrame, keys, order) -> DataFrame:
    """One row per key: the one smallest by ``order`` (a column list).

    Done as ``min(struct(order..., row))`` grouped by key: a partial
    aggregate, so a key holding a third of all rows is combined map-side
    instead of sorting in one task as a window would. The struct carries
    every column of ``df`` (the optimizer cannot prune inside it), so pass
    only the columns the result needs.
    """
    keys = _keys(keys)
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
                      F.struct(*rest).alias("_row"))
    return (df.groupBy(*keys).agg(F.min(packed).alias("_m"))
              .select(*keys, "_m._row.*").select(*df.columns))


def upsert(table: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Insert or replace by key (replay-safe). New rows with the same key
    collapse to the smallest of them (the same one on a replay)."""
    new = dedupe_first(new, key, [])
    return table.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def partial_update(table: DataFrame, updates: DataFrame, key: str, cols) -> DataFrame:
    """Set only ``cols`` of matching keys; an explicit NULL in the update
    overwrites (``when``, not ``coalesce``)."""
    cols = list(cols)
    u = dedupe_first(updates.select(key, *cols), key, []).select(   # of repeated keys the smallest row, each time
        key, *[F.col(c).alias(f"_u_{c}") for c in cols], F.lit(True).alias("_hit"))
    j = table.join(u, key, "left")
    out = []
    for c in table.columns:
        if c in cols:
            out.append(F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    extra = [F.col(f"_u_{c}").alias(c) for c in cols if c not in table.columns]
    return j.select(*out, *extra)


def insert_ignore(table: DataFrame, new: DataFrame, keys) -> DataFrame:
    """Rows of ``new`` whose unique keys are all unseen, first per key in
    input order (``order`` column or the keys). Returns only the inserted
    rows; union them with the table to get the new table."""
    keys = _keys(keys)
    fresh = new
    for k in reversed(keys):  # the anti join by the first key and its dedupe share one exchange
        fresh = fresh.join(table.select(k), k, "left_anti")
    for k in keys:
        fresh = dedupe_first(fresh, k, [c for c in ("order",) if c in fresh.columns] or [k])
    return fresh.select(*new.columns)


def delete_by_key(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return table.join(keys.select(key).distinct(), key, "left_anti")


def read_by_ids(table: DataFrame, ids: DataFrame, key: str, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """Rows whose key is in the id list, plus the list of bad ids (not a
    24-hex id) that were skipped."""
    ok = ids.filter(is_object_id(id_col)).select(F.lower(id_col).alias(key)).distinct()
    bad = ids.filter(~is_object_id(id_col))
    return table.join(ok, key, "left_semi"), bad


def dead_letter(work: DataFrame, reason_col: str = "reject_reason", added=None) -> tuple[DataFrame, DataFrame]:
    """Split rows with a reject reason off into the rejects table shape."""
    ok = work.filter(F.col(reason_col).isNull()).drop(reason_col)
    bad = work.filter(F.col(reason_col).isNotNull()).withColumnRenamed(reason_col, "reason")
    if added is not None:
        bad = bad.withColumn("added", F.lit(added).cast("timestamp"))
    return ok, bad


def advance_stage(work: DataFrame, moved: DataFrame, stage: str, now) -> DataFrame:
    """Work rows listed in ``moved`` (by article_id) get their next stage
    and a new last_action time."""
    upd = moved.select("article_id").distinct().select(
        "article_id", F.lit(stage).alias("stage"), F.lit(now).cast("timestamp").alias("last_action"))
    return partial_update(work, upd, "article_id", ["stage", "last_action"])
