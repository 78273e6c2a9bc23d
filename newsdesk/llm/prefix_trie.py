"""Conversation prefix trie by fixed-length block hashing.

A node is a distinct sequence of the first d turns (role, text) of the
conversations; those that start with it are its members. Turns are hashed with
their position (two hashes of 64 bits; what agrees in both is taken as equal),
and the hash of a sequence is the exclusive or of its turns' hashes, so that a
prefix hash is a sum that tasks can build in parts.

1. Conversations are cut into blocks of ``BLOCK`` turns and grouped by
   successive block digests: a class is one block content after one path of
   blocks, with the number of its conversations. Copies cost one row from here.
2. A class without siblings (no other content follows the same path) holds its
   turn boundaries as they are: all nodes in it have the class's members.
3. Turn boundaries are refined only in blocks where siblings diverge: the turns
   of those classes are grouped by their prefix hash.

What a node sums over its subtree is summed over its members instead, which is
the same block-wise pass once more:

* every childless node is counted by its smallest member, so ``n_leaves`` of a
  node is the number of such conversations among its members;
* of a node, all members but the smallest repeat its last turn. A conversation
  is the smallest of all nodes on its path from some depth on, so what it
  repeats is the words of its turns above that depth: one number for each
  conversation, from which ``saved_tokens`` follows.

No group is held in memory: a conversation of very many turns is ranked and
hashed in ranges, a node of very many conversations is summed before shuffling,
and the members that end at a node pass by in order under one running SHA-256
(a hash that can't be built in parts).

Defined results: turns are ordered by turn (null first), then role, then text;
a null role or text is empty; rows that are alike are turns of their own; rows
without a conv_id belong to no conversation and are left out; no rows give no
nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from newsdesk.llm.common import partitions, settled

BLOCK = 4
SPAN = 1024  # blocks of a conversation that one window orders
WORD = r"[^\x20\x09-\x0D]+"
_PATH, _CLASS = ["block", "e1", "e2"], ["block", "e1", "e2", "x1", "x2", "n"]
_NODE = ["depth", "k1", "k2"]


def ranked(conversations: DataFrame) -> DataFrame:
    """conv_id, depth (from 1, in the conversation's order), c1, c2 (hashes of
    role and text), words. The order is a range sort over all conversations, and
    a turn's depth its place in its range after what earlier ranges hold of its
    conversation: a conversation of any length is spread over tasks."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = (conversations.where("conv_id is not null")
            .select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .withColumn("tie", F.monotonically_increasing_id()))  # rows that are alike need not be in one range
    rows = rows.repartitionByRange(partitions(conversations.sparkSession), *order, F.col("tie")).sortWithinPartitions(*order)
    placed = settled(rows.select(
        "conv_id", F.xxhash64("role", "text").alias("c1"), F.xxhash64(F.lit(1), "text", "role").alias("c2"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "turns")
    parts = placed.groupBy("conv_id", "part").agg(F.min("at").alias("low"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low") + 1).alias("shift"))
    return placed.join(parts, ["conv_id", "part"]).select("conv_id", (F.col("at") + F.col("shift")).alias("depth"), "c1", "c2", "words")


def with_borrowed_heads(turns: DataFrame, base: Column, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) after each conversation's first ``heads`` turns
    (a number up to ``most``) are replaced by the first turns of the
    conversation ``base`` (all if fewer, none if absent). Both columns are
    expressions of conv_id."""
    turns = settled(turns, "ranked")
    convs = turns.select("conv_id").distinct().select("conv_id", base.alias("base"), heads.cast("long").alias("heads"))
    first = turns.where(F.col("depth") <= most).withColumnRenamed("conv_id", "base")
    borrowed = convs.join(first, "base").where("depth <= heads").select(*turns.columns)
    lengths = first.groupBy("base").agg(F.max("depth").alias("length"))
    convs = convs.join(lengths, "base", "left").select("conv_id", "heads", F.least("heads", F.coalesce("length", F.lit(0))).alias("got"))
    own = turns.join(convs, "conv_id").where("depth > heads").withColumn("depth", F.col("depth") - F.col("heads") + F.col("got"))
    return borrowed.unionByName(own.select(*turns.columns)), convs.select("conv_id")


def _blocks(turns: DataFrame) -> DataFrame:
    """A row for each block of a conversation: its class (path e1, e2 before it,
    digest x1, x2, n turns) and ``nodes``, its turn boundaries: depth, hash of
    the prefix and of the one before, words of the last turn and of all."""
    placed = turns.select("conv_id", F.floor((F.col("depth") - 1) / BLOCK).alias("block"), "depth",
                          F.xxhash64("depth", "c1").alias("p1"), F.xxhash64("depth", "c2", "c1").alias("p2"), "words")
    blocks = placed.groupBy("conv_id", "block").agg(
        F.bit_xor("p1").alias("x1"), F.bit_xor("p2").alias("x2"), F.count("*").alias("n"), F.sum("words").alias("w"),
        F.sort_array(F.collect_list(F.struct("depth", "p1", "p2", "words"))).alias("turns"))  # at most BLOCK of them
    blocks = settled(blocks.withColumn("span", F.floor(F.col("block") / SPAN)), "blocks")
    so_far = "over (partition by conv_id{} order by {} rows between unbounded preceding and 1 preceding)"

    def before(df: DataFrame, by: str, inner: str) -> list[Column]:
        over = so_far.format(inner, by)
        return [F.expr(f"coalesce(bit_xor(x1) {over}, 0)"), F.expr(f"coalesce(bit_xor(x2) {over}, 0)"), F.expr(f"coalesce(sum(w) {over}, 0)")]

    spans = blocks.groupBy("conv_id", "span").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("w").alias("w"))
    a1, a2, aw = before(spans, "span", "")
    spans = spans.select("conv_id", "span", a1.alias("s1"), a2.alias("s2"), aw.alias("sw"))
    b1, b2, bw = before(blocks, "block", ", span")
    blocks = (blocks.withColumns({"i1": b1, "i2": b2, "iw": bw}).join(spans, ["conv_id", "span"])
              .withColumns({"e1": F.expr("i1 ^ s1"), "e2": F.expr("i2 ^ s2"), "w0": F.col("iw") + F.col("sw")}))
    # prefixes within the block: an entry for each of its turns
    upto = "aggregate(slice(turns, 1, {}), {}, (a, t) -> a {} t.{})"
    nodes = ("transform(turns, (t, k) -> named_struct('depth', t.depth, "
             f"'k1', {upto.format('k + 1', 'e1', '^', 'p1')}, 'k2', {upto.format('k + 1', 'e2', '^', 'p2')}, "
             f"'q1', {upto.format('k', 'e1', '^', 'p1')}, 'q2', {upto.format('k', 'e2', '^', 'p2')}, "
             f"'words', t.words, 'upto', {upto.format('k + 1', 'w0', '+', 'words')}))")
    return blocks.select("conv_id", *_CLASS, F.expr(nodes).alias("nodes"))


def _ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The digest of each node's conversations, which come in order."""
    key, digest = None, None
    for b in batches:
        done = []
        for depth, k1, k2, conv in zip(b["depth"].tolist(), b["k1"].tolist(), b["k2"].tolist(), b["conv_id"].tolist()):
            if key != (depth, k1, k2):
                if key:
                    done.append((*key, digest.hexdigest()))
                key, digest = (depth, k1, k2), hashlib.sha256(str(conv).encode())
            else:
                digest.update(f",{conv}".encode())
        if done:
            yield pd.DataFrame(done, columns=[*_NODE, "ends_sha256"])
    if key:
        yield pd.DataFrame([(*key, digest.hexdigest())], columns=[*_NODE, "ends_sha256"])


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie over ``turns`` (conv_id, depth, c1, c2, words; depths from 1
    without gaps) of the conversations ``convs`` (conv_id; with those that have
    no turn). Per node: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    blocks = settled(_blocks(turns), "paths")
    classes = settled(blocks.groupBy(*_CLASS).agg(F.count("*").alias("n_convs"), F.min(F.struct("conv_id", "nodes")).alias("one")), "classes")
    # a class alone on its path: the only content that follows it
    alone = (classes.groupBy(*_PATH).agg(F.count("*").alias("contents"), F.min(F.struct("x1", "x2", "n")).alias("it"))
             .where("contents = 1").select(*_PATH, "it.*", F.lit(True).alias("alone")))
    classes = classes.join(alone, _CLASS, "left")
    each = classes.select("alone", "n_convs", "one.conv_id", F.explode("one.nodes").alias("node")).select("alone", "n_convs", "conv_id", "node.*")
    rest = ["q1", "q2", "words", "upto"]
    whole = each.where("alone").select(*_NODE, *rest, "n_convs", "conv_id")
    refined = each.where("alone is null").groupBy(*_NODE).agg(
        *[F.min(c).alias(c) for c in rest], F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
        *[F.lit(0).cast("long").alias(c) for c in (*_NODE, *rest)], "n_convs", "conv_id")
    nodes = settled(whole.unionByName(refined).unionByName(root), "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(
        F.count("*").alias("n_children"))

    last = blocks.groupBy("conv_id").agg(F.max_by(F.element_at("nodes", -1), "block").alias("end"))
    zero = F.lit(0).cast("long")
    ends = settled(convs.join(last, "conv_id", "left").select(
        "conv_id", *[F.coalesce(F.col(f"end.{c}"), zero).alias(c) for c in (*_NODE, "upto")]), "ends")
    # the words a conversation repeats, and whether it counts the node it ends at as childless
    least = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", (F.col("upto") - F.col("words")).alias("repeats"))).alias("m"))
    leaves = (nodes.join(children, _NODE, "left_anti").select(*_NODE, "conv_id", F.lit(1).cast("long").alias("leaf")))
    each_conv = settled(ends.join(leaves, [*_NODE, "conv_id"], "left").join(least, "conv_id", "left").select(
        "conv_id", F.coalesce("m.repeats", "upto").alias("repeats"), F.coalesce("leaf", zero).alias("leaf")), "conversations")

    sums = blocks.select("conv_id", *_CLASS).join(each_conv, "conv_id").groupBy(*_CLASS).agg(F.sum("repeats").alias("repeats"), F.sum("leaf").alias("leaf"))
    of_node = (classes.select(*_CLASS, "one.nodes").join(sums, _CLASS)
               .select("repeats", "leaf", F.explode("nodes").alias("node")).select("node.depth", "node.k1", "node.k2", "repeats", "leaf")
               .groupBy(*_NODE).agg(F.sum("repeats").alias("repeats"), F.sum("leaf").alias("leaf")))
    of_root = each_conv.agg(F.sum("repeats").alias("repeats"), F.sum("leaf").alias("leaf")).select(*[zero.alias(c) for c in _NODE], "repeats", "leaf")
    ended = (ends.select(*_NODE, "conv_id").repartition(*_NODE).sortWithinPartitions(*_NODE, "conv_id")
             .mapInPandas(_ends, "depth long, k1 long, k2 long, ends_sha256 string"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    smallest = each_conv.select("conv_id", F.col("repeats").alias("own"))
    out = (nodes.join(of_node.unionByName(of_root), _NODE).join(children, _NODE, "left").join(ended, _NODE, "left")
           .join(parents, ["depth", "q1", "q2"], "left").join(smallest, "conv_id"))
    saved = F.col("repeats") - F.col("own") - (F.col("n_convs") - 1) * (F.col("upto") - F.col("words"))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
                      F.col("leaf").alias("n_leaves"), saved.alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of ``conversations`` (conv_id, turn, role, text) as they are."""
    turns = settled(ranked(conversations), "ranked")
    return trie(turns, turns.select("conv_id").distinct())


def shared_prefix_trie(conversations: DataFrame, family: int = 20, most: int = 3) -> DataFrame:
    """The trie of ``conversations`` after each conversation c begins with the
    first h turns of the first of its family (c - c % ``family``), where h is
    the crc32 of c in decimals modulo ``most`` + 1, and goes on with its own
    turns after its first h."""
    c = F.col("conv_id")
    turns, convs = with_borrowed_heads(ranked(conversations), c - c % family, F.crc32(c.cast("string").cast("binary")) % (most + 1), most)
    return trie(settled(turns, "rebuilt"), settled(convs, "members"))
