"""Helpers shared by the operators: table access, settled tables, hold-outs,
workers' memory."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsdesk.session import apply_conf, ensure_checkpoint_dir, ship_package

# A word: a run of characters other than ASCII white space.
SPACE = r" \t\n\x0B\f\r"

_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Session settings, the shared folder and the package on the executors;
    once per application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        apply_conf(spark)
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: cuts the
    lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """What was freed goes back to the system; the allocators of Arrow and of
    the C library would keep a task's large arrays for as long as the worker lives."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def unused(df: DataFrame, name: str) -> str:
    """``name``, longer by underscores until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null id: as the text '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
