"""Tables of the batch jobs: versioned snapshots and append-only parts.

A write goes to a folder of its own and becomes visible by a commit that can
only be made once: version n of a snapshot table is a small file that is created
and never replaced. Of two writers that start from the same version one gets the
number; the other reads what the first wrote, derives its change again and
commits the next number (``update``), so both survive. A failed or retried job
leaves earlier versions as they are, and readers never see a half-written table.

Listing goes through the Hadoop FileSystem of the path, so the same code
works on local disk, HDFS or an object store.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from newsdesk.session import checkpoint_dir


class Scratch:
    """Rows written to the shared folder and read back: computed once, kept when
    an executor is lost, and a short plan for what is built on them. ``remove``
    deletes the folder after use."""

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.path = checkpoint_dir(self.spark, "scratch", uuid.uuid4().hex)
        df.write.parquet(self.path)
        self.rows = self.spark.read.schema(df.schema).parquet(self.path)

    def remove(self) -> None:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class ConflictError(RuntimeError):
    """Another writer committed the version that was asked for."""


class TableStore:
    """``<root>/<table>/data/<id>`` holds the rows of a write,
    ``<root>/<table>/versions/<n>`` the id of version n."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or checkpoint_dir(spark, "tables")

    # -- file system helpers -------------------------------------------------
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _pointer(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/versions/{version:010d}"

    def versions(self, table: str) -> list[int]:
        """Committed versions of a table, oldest first."""
        fs, p = self._fs(f"{self.root}/{table}/versions")
        if not fs.exists(p):
            return []
        return sorted(int(st.getPath().getName()) for st in fs.listStatus(p)
                      if st.getPath().getName().isdigit() and st.getLen() > 0)

    def version(self, table: str) -> int:
        """The newest version; 0 for a table that was never written."""
        return max(self.versions(table), default=0)

    def exists(self, table: str) -> bool:
        return bool(self.versions(table))

    def path(self, table: str, version: int) -> str:
        fs, p = self._fs(self._pointer(table, version))
        stream = fs.open(p)
        try:
            name = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return f"{self.root}/{table}/data/{name}"

    # -- read / write ----------------------------------------------------------
    def read(self, table: str, schema=None, version: int | None = None) -> DataFrame:
        v = self.version(table) if version is None else version
        if not v:
            if schema is None:
                raise FileNotFoundError(f"table {table} has no committed version under {self.root}")
            return self.spark.createDataFrame([], schema)
        r = self.spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(self.path(table, v))

    def _stage(self, table: str, df: DataFrame) -> str:
        name = uuid.uuid4().hex
        df.write.mode("errorifexists").parquet(f"{self.root}/{table}/data/{name}")
        return name

    def _commit(self, table: str, version: int, name: str) -> bool:
        """Give the staged rows a version number; False when it is taken."""
        fs, p = self._fs(self._pointer(table, version))
        try:
            out = fs.create(p, False)        # create only: never replaces
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName() or fs.exists(p):
                return False
            raise
        try:
            out.write(bytearray(name.encode()))
        finally:
            out.close()
        return True

    def write(self, table: str, df: DataFrame, base: int | None = None) -> int:
        """Write ``df`` as the next version and return its number. With
        ``base`` (the version ``df`` was derived from) a newer version is a
        ``ConflictError``; without it the table is replaced whatever it holds."""
        if base is not None and self.version(table) != base:
            raise ConflictError(f"{table} is at version {self.version(table)}, not {base}")
        name = self._stage(table, df)
        v = (self.version(table) if base is None else base) + 1
        while not self._commit(table, v, name):
            if base is not None:
                raise ConflictError(f"version {v} of {table} was committed by another writer")
            v += 1
        return v

    def update(self, table: str, change: Callable[[DataFrame], DataFrame], schema=None, tries: int = 10) -> int:
        """Replace the table by ``change(table)``. When another writer commits
        first, its version is read and the change derived from that."""
        for _ in range(tries):
            base = self.version(table)
            name = self._stage(table, change(self.read(table, schema, base)))
            if self._commit(table, base + 1, name):
                return base + 1
        raise ConflictError(f"{table}: {tries} other writers came first")

    def vacuum(self, table: str, keep: int = 3) -> list[int]:
        """Remove all but the newest ``keep`` versions; returns the removed."""
        vs = self.versions(table)
        gone = vs[:-keep] if keep > 0 else vs
        for v in gone:
            for path in (self.path(table, v), self._pointer(table, v)):
                fs, p = self._fs(path)
                fs.delete(p, True)
        return gone


class PartTable:
    """An append-only fact table (articles, rejects, urls). A batch writes a part;
    the folder ``part=<key>/write=<id>`` is new for each write, and the newest
    committed write of a part is the current one: a replayed batch replaces
    exactly its own rows, and the rows it replaces can still be read (to take
    them out of counts) until ``vacuum``. Readers get the union of the parts
    (newest part wins per key when ``key`` is set)."""

    def __init__(self, store: TableStore, table: str, key: str | None = None, partition_by: str | None = None):
        self.store, self.table, self.key, self.partition_by = store, table, key, partition_by

    def path(self) -> str:
        return f"{self.store.root}/{self.table}"

    @staticmethod
    def part_value(part: str) -> str:
        """Folder value of a part; the letter keeps the partition column a
        string (no numeric inference), so names keep their sort order."""
        return f"k{part}"

    def writes(self) -> dict[str, list[str]]:
        """Committed writes of each part (folder values), oldest first."""
        fs, p = self.store._fs(f"{self.path()}/part=*/write=*/_SUCCESS")
        out: dict[str, list[str]] = {}
        for st in fs.globStatus(p) or []:
            folder = st.getPath().getParent()
            out.setdefault(folder.getParent().getName()[len("part="):], []).append(folder.getName()[len("write="):])
        return {part: sorted(ws) for part, ws in sorted(out.items())}

    def current(self) -> dict[str, str]:
        """The write that each part consists of."""
        return {part: ws[-1] for part, ws in self.writes().items()}

    def parts(self) -> list[str]:
        """Folder values of the committed parts, in name (= time) order."""
        return list(self.writes())

    def append(self, df: DataFrame, part: str) -> str:
        part = self.part_value(part)
        last = self.current().get(part, "w0")
        at = max(int(time.time() * 1000), int(last[1:].split("-")[0]) + 1)   # after the writes that are there
        p = f"{self.path()}/part={part}/write=w{at:014d}-{uuid.uuid4().hex[:8]}"
        w = df.write.mode("errorifexists")
        (w.partitionBy(self.partition_by) if self.partition_by else w).parquet(p)
        return p

    def rows(self, schema, writes: dict[str, str]) -> DataFrame:
        """The rows of the given writes (part -> write) with column ``part``."""
        paths = [f"{self.path()}/part={p}/write={w}" for p, w in writes.items()]
        if not paths:
            return self.store.spark.createDataFrame([], schema).withColumn("part", F.lit(None).cast("string"))
        return self.store.spark.read.schema(schema).option("basePath", self.path()).parquet(*paths).drop("write")

    def read(self, schema, exclude_part: str | None = None, columns: list[str] | None = None) -> DataFrame:
        """Union of the parts; ``exclude_part`` leaves one part out (a job
        writing that part again must not read it). ``columns`` narrows the
        read before the per-key dedupe, whose aggregated struct would otherwise
        pull every column through the scan."""
        now = self.current()
        if exclude_part is not None:
            now.pop(self.part_value(exclude_part), None)
        df = self.rows(schema, now)
        if columns is not None:
            df = df.select(*dict.fromkeys(([self.key] if self.key else []) + list(columns) + ["part"]))
        return df if self.key is None else newest_per_key(df, self.key)

    def vacuum(self, keep: dict[str, str] | None = None) -> list[str]:
        """Remove the writes that are neither current nor in ``keep`` (those
        a cursor still refers to); returns the removed folders."""
        now, keep, gone = self.current(), keep or {}, []
        for part, ws in self.writes().items():
            for w in ws:
                if w not in (now[part], keep.get(part)):
                    fs, p = self.store._fs(f"{self.path()}/part={part}/write={w}")
                    fs.delete(p, True)
                    gone.append(f"part={part}/write={w}")
        return gone


class KeyIndex:
    """What is stored under a key (the urls of saved articles, links that were
    queued), as rows in folders of ``buckets`` hash ranges of the key. A batch is
    held against all history by a join on (bucket, key) in the buckets it touches
    alone: the scan doesn't list the others. Batches are parts, with the replay
    rule of ``PartTable``."""

    def __init__(self, store: TableStore, table: str, key: str, columns: list[str], buckets: int = 64):
        self.key, self.columns, self.buckets = key, [key, *columns], buckets
        self.schema = ", ".join(f"{c} string" for c in self.columns)
        self.parts = PartTable(store, table, partition_by="bucket")

    def bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def add(self, rows: DataFrame, part: str) -> None:
        """A batch's rows (those without a key left out, repeated ones once).
        A bucket is written by one task, or by more where it is large."""
        rows = rows.filter(F.col(self.key).isNotNull()).select(*self.columns).distinct().withColumn("bucket", self.bucket())
        self.parts.append(rows.hint("rebalance", "bucket"), part)

    def stored(self, keys: DataFrame, exclude_part: str | None = None, with_part: bool = False) -> DataFrame:
        """The stored rows that have one of ``keys`` (a DataFrame with the key)."""
        now = self.parts.current()
        if exclude_part is not None:
            now.pop(PartTable.part_value(exclude_part), None)
        rows = self.parts.rows(self.schema, now)
        if not now or "bucket" not in rows.columns:                      # nothing stored yet
            return self.parts.store.spark.createDataFrame([], self.schema + ", part string" * with_part)
        asked = keys.filter(F.col(self.key).isNotNull()).select(self.key).distinct().withColumn("bucket", self.bucket())
        # at most ``buckets`` rows. The range of the keys skips what is stored outside of it by the files' statistics:
        # all history, where keys are in order of time
        touched = asked.groupBy("bucket").agg(F.min(self.key).alias("low"), F.max(self.key).alias("high")).collect()
        rows = rows.filter(F.col("bucket").isin(sorted(r.bucket for r in touched)))
        if touched:
            rows = rows.filter(F.col(self.key).between(min(r.low for r in touched), max(r.high for r in touched)))
        return rows.join(asked, ["bucket", self.key], "left_semi").select(*self.columns, *["part"] * with_part)

    def newest(self, keys: DataFrame, exclude_part: str | None = None) -> DataFrame:
        """Of each of ``keys`` that is stored, the row of its newest part."""
        rows = self.stored(keys, exclude_part, with_part=True)
        return newest_per_key(rows, self.key).select(*self.columns)

    def compact(self, newest_only: bool = False) -> None:
        """Fold all parts into one, so that the files of a bucket don't grow in
        number with the batches; with ``newest_only`` one row for a key. It has a name of its own: a batch that runs
        again afterwards finds its own rows in it."""
        now = self.parts.current()
        if now:
            rows = newest_per_key(self.parts.rows(self.schema, now), self.key) if newest_only else self.parts.rows(self.schema, now)
            self.add(rows, f"{max(now)[1:]}.base")
            for p, w in now.items():
                fs, path = self.parts.store._fs(f"{self.parts.path()}/part={p}/write={w}")
                fs.delete(path, True)


def url_index(store: TableStore, table: str = "article_urls", buckets: int = 64) -> KeyIndex:
    """The (url, article_id) of all saved articles."""
    return KeyIndex(store, table, "url", ["article_id"], buckets)


def newest_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key from the newest part (part names sort in time order):
    a grouped max of a struct led by the part name, combined map-side."""
    rest = [c for c in df.columns if c not in (key, "part")]
    return (df.groupBy(key).agg(F.max(F.struct(F.col("part").cast("string").alias("_p"),
                                               *[F.col(c) for c in rest])).alias("_m"))
              .select(key, *[F.col(f"_m.{c}").alias(c) for c in rest]))
