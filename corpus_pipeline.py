"""The corpus pipeline: documents through quality rules, toxicity, near-duplicate
removal and packing. Each stage reads all that the one before kept, as Parquet;
all but the last return the columns of ``documents``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from newsdesk.llm import neardup, packing, quality, toxicity
from newsdesk.llm.common import prepare, table
from newsdesk.llm.queries import vocabulary
from newsdesk.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the risk-controlled rules reject go."""
    prepare(spark)
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon scores one half or more go."""
    prepare(spark)
    return toxicity.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: shingles of five words, 0.8."""
    prepare(spark)
    return neardup.keep(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document in sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality rules", quality_rules), ("toxicity", toxic_documents),
          ("MinHash near-dedup", near_duplicates), ("best-fit packing", packed)]

#: The stages learn, compare sets and solve a program, which SQL does not
#: express; tests/llm holds the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    to = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{to}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{to}/{k}")
