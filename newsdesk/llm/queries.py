"""Registered queries of the subpackage: QUERIES[name](spark, sf_dir) and, where
SQL can express the result, ORACLE[name] in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsdesk.llm import (bpe_tree, collocations, language_model, licenses, neardup, oracles, packing, prefix_trie, quality, quotes,
                          search, suffix_dedup, token_files, toxicity)
from newsdesk.llm.common import fold_of, prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    QUERIES[fn.__name__] = run
    return run


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.decide(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", *quality.COUNTS, "base_failed", "kept")


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=4)


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    to = token_files.new_folder(spark)
    token_files.write(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), to)
    return token_files.read(spark, to).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op6_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents whose id is divisible by 20, as queries, against all."""
    return search.search(table(spark, sf_dir, "documents"), F.col("doc_id") % 20 == 0)


@query
def op7_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quotes.ordered(quotes.linked(table(spark, sf_dir, "conversations")))
    return found.select("conv_id", "turn", "role", "parent_turn", "root_turn", "depth", "n_quoted", F.sha2("text", 256).alias("text_sha256"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    found = toxicity.scored(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"), F.col(toxicity.SCORE).alias("score"),
                        (F.col(toxicity.SCORE) >= 0.5).cast("int").alias("predicted"))


@query
def op9_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(table(spark, sf_dir, "documents"), language_model.held_out_sevenths())


@query
def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe_tree.encode_and_decode(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return found.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.shared_prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE.update(op11_prefix_trie=oracles.PREFIX_TRIE, op12_phrase_collocations=oracles.COLLOCATIONS, op13_suffix_dedup=oracles.SUFFIX_DEDUP)
