"""Scoring by a hashed maximum-entropy language model.

A token's probability is that of its class given the two words before it times
its own within the class. Both factors are softmax models over hashed features:
the word before (n-gram) and the word before that (skip), next to a bias. The
``HEAD`` most frequent training tokens, cut by frequency into ``CLASSES``
classes of equal counts, are members by name. All other words are one class,
whose members are groups that they are dealt into by hash, a group for each
``GROUP`` of their training tokens. Within a group a word is found by two-way choices down a tree of the group's words. Each choice
is a softmax over the words before by their full hash, in tables as large as the
group has tokens, on top of what the words' counts say. A word not met in
training has the share of one count in its group.

Counts of (contexts, class) and (contexts, member) over all training tokens are
gathered by Spark; their number of cells is bounded by the model's size, their
sums by the input. Each step of training computes the gradient from them in the
tasks, in parts of the context space, and adds the parts up. The tokens of a
group meet in one task, which counts its words, learns its tree and scores them:
nothing of the words outside the head is broadcast or collected. Texts are split
into words once: the words' hashes are written, and counting, gathering and
scoring read those.

The base score is that of single tokens, add-one: log10((c + 1) / (N + V + 1)).

Defined results: words are runs of characters other than ASCII white space with
A-Z in lower case; null, empty and blank texts are one end token; rows that
repeat a doc_id get a row each; a null doc_id stays null; without training
tokens every count is 0 and the model is the base model; no rows give no rows.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from newsdesk.llm.common import fold_of, give_back, settled

HEAD, CLASSES = 4096, 31
PREV, SKIP, NEAR, FAR = 256, 64, 64, 8  # buckets of the class model's features, and of the member model's
GROUP = 250_000
STEPS, PARTS = 20, 8
ROUNDS, PRIOR = 2, 1.0  # Newton steps of a choice in a group, and their Gaussian prior
NODES = 1 << 15  # tokens of nodes that are taken together
HELD = 1_000_000  # tokens that a task keeps before it counts their cells or deals them out
END = b"\x00 end"  # no word holds a space
REMEMBERED = 1_000_000
TOKENS = 500_000  # handled at once, where the texts allow it
_LOG10 = math.log(10)


def _key(token: bytes) -> int:
    """A signed 64-bit name of a token."""
    h = xxhash.xxh64_intdigest(token)
    return h - (1 << 64) if h >> 63 else h


class _Keys(dict):
    def __missing__(self, token: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        k = self[token] = _key(token)
        return k


_KEYS = _Keys()


def _tokens(text: str | None) -> np.ndarray:
    words = (text or "").encode("utf-8", "replace").lower().split()
    words.append(END)
    return np.fromiter(map(_KEYS.__getitem__, words), np.int64, len(words))


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(values, return_counts=True)


def tokenised(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, keys: the tokens of each row as little-endian 64-bit names."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "held_out": b["held_out"],
                                "keys": [_tokens(t).astype("<i8").tobytes() for t in b["text"].tolist()]})
        _KEYS.clear()
        give_back()

    return docs.select("doc_id", "held_out", "text").mapInPandas(run, "doc_id long, held_out boolean, keys binary")


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """Rows, their tokens one after the other, and where each row's begin, for
    about ``TOKENS`` tokens of a batch at a time."""
    for b in batches:
        n = np.array([len(k) // 8 for k in b["keys"]], np.int64)
        part = (np.cumsum(n) - n) // TOKENS
        for p in np.unique(part):
            rows, size = b[part == p], n[part == p]
            yield rows, np.frombuffer(b"".join(rows["keys"]), "<i8"), np.cumsum(size) - size


def token_counts(tokens: DataFrame) -> DataFrame:
    """key, c: how often each token occurs in the rows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0

        def out() -> pd.DataFrame:
            keys, c = _runs(np.concatenate(held))
            return pd.DataFrame({"key": keys, "c": c})

        for _, keys, _ in _parts(batches):
            held.append(keys)
            n += len(keys)
            if n > 8_000_000:
                yield out()
                held, n = [], 0
        if n:
            yield out()
            held = []
        give_back()

    return tokens.select("keys").mapInPandas(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """The head: sorted keys, and of each its class and counts; the totals."""
    keys: np.ndarray
    of: np.ndarray
    counts: np.ndarray
    tokens: int
    distinct: int

    def ids(self, keys: np.ndarray) -> np.ndarray:
        """Places in the head, -1 outside."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def classes(self, ids: np.ndarray) -> np.ndarray:
        if not len(self.of):
            return np.full(len(ids), CLASSES)
        return np.where(ids >= 0, self.of[ids], CLASSES)

    @property
    def groups(self) -> int:
        """How many groups the words outside the head are dealt into."""
        return 1 + (self.tokens - int(self.counts.sum())) // GROUP

    @property
    def members(self) -> np.ndarray:
        """The class of each member: of the head's words, then of the groups."""
        return np.append(self.of, np.full(self.groups, CLASSES)).astype(np.int64)

    def group(self, keys: np.ndarray) -> np.ndarray:
        return ((_mixed(keys) >> np.uint64(11)) % np.uint64(self.groups)).astype(np.int64)

    @property
    def rest(self) -> float:
        """Smoothed mass outside the head: of its words, and of one unseen."""
        return float(self.tokens - self.counts.sum() + self.distinct - len(self.keys) + 1)


def vocabulary(counts: DataFrame, head: int = HEAD) -> Vocabulary:
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    top = counts.orderBy(F.desc("c"), "key").limit(head).collect()
    c = np.array([r["c"] for r in top], np.int64)
    cut = np.minimum((np.cumsum(c) - c) * CLASSES // max(1, int(c.sum())), CLASSES - 1) if len(c) else c
    keys = np.array([r["key"] for r in top], np.int64)
    by = np.argsort(keys)
    return Vocabulary(keys[by], cut[by].astype(np.int64), c[by], total["n"] or 0, total["v"])


def _mixed(keys: np.ndarray) -> np.ndarray:
    u = keys.astype(np.int64).view(np.uint64)
    return (u ^ (u >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _contexts(keys: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word before each token of some texts and of the one before
    that. Every text has a token."""
    first, u = _mixed(np.array([_KEYS[b"\x00 start"]], np.int64)), _mixed(keys)
    before, skip = np.empty_like(u), np.empty_like(u)
    before[1:], skip[2:] = u[:-1], u[:-2]
    before[begins] = first
    skip[begins] = first
    skip[begins[begins + 1 < len(u)] + 1] = first  # of a text of one token: the next one's first
    return before, skip


def _bucket(hashes: np.ndarray, shift: int, buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(shift)).astype(np.int64) % buckets


def _cells(keys: np.ndarray, begins: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each token: its place in the head (-1 outside), its cell of the class
    table and its cell of the member table."""
    ids = vocab.ids(keys)
    before, skip = _contexts(keys, begins)
    of_class = (_bucket(before, 56, PREV) * SKIP + _bucket(skip, 40, SKIP)) * (CLASSES + 1) + vocab.classes(ids)
    near = _bucket(before, 24, NEAR) * FAR + _bucket(skip, 8, FAR)
    m = len(vocab.keys)
    return ids, of_class, near * (m + vocab.groups) + np.where(ids >= 0, ids, m + vocab.group(keys))


def gathered(tokens: DataFrame, vocab: Vocabulary) -> DataFrame:
    """member (boolean), cell, n: the counts that training needs."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = PREV * SKIP * (CLASSES + 1), NEAR * FAR * len(vocab.members)
        total, held = [np.zeros(n, np.int64) for n in size], []

        def add() -> None:
            for k, cells in enumerate(zip(*held)):
                np.add(total[k], np.bincount(np.concatenate(cells), minlength=size[k]), out=total[k])
            held.clear()
            give_back()

        for _, keys, begins in _parts(batches):
            held.append(_cells(keys, begins, vocab)[1:])
            if sum(len(cells) for cells, _ in held) > HELD:
                add()
        add()
        for k in (0, 1):
            has = np.flatnonzero(total[k])
            yield pd.DataFrame({"member": bool(k), "cell": has, "n": total[k][has]})
        del total, has
        give_back()

    return tokens.select("keys").mapInPandas(run, "member boolean, cell long, n long").groupBy("member", "cell").agg(F.sum("n").alias("n"))


@dataclass
class Weights:
    bias: np.ndarray    # classes
    prev: np.ndarray    # PREV x classes
    skip: np.ndarray    # SKIP x classes
    word: np.ndarray    # members
    near: np.ndarray    # NEAR x members
    far: np.ndarray     # FAR x members

    def arrays(self) -> list[np.ndarray]:
        return [self.bias, self.prev, self.skip, self.word, self.near, self.far]


def _softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=-1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=-1, keepdims=True))


def _class_logs(w: Weights, prev: np.ndarray) -> np.ndarray:
    """ln P(class | prev, skip) for some values of prev and all of skip."""
    return _softmax(w.bias + w.prev[prev][:, None, :] + w.skip[None, :, :])


def _member_logs(w: Weights, context: np.ndarray, of: np.ndarray) -> np.ndarray:
    """ln P(member | its class, near, far), for some of their pairs."""
    z = w.word + w.near[context // FAR] + w.far[context % FAR]
    out = np.empty_like(z)
    for c in np.unique(of):
        at = of == c
        out[:, at] = _softmax(z[:, at])
    return out


def train(cells: DataFrame, vocab: Vocabulary, steps: int = STEPS) -> Weights:
    """Gradient steps (Adagrad, from the single-token model on). The table of
    counts is dealt out by context; each task returns the gradient of its part,
    the driver adds up ``PARTS`` of them a step: the model's size, not the
    input's."""
    of, classes = vocab.members, CLASSES + 1
    m, mass = len(of), np.bincount(vocab.of.astype(np.int64), vocab.counts, CLASSES)
    groups = np.full(vocab.groups, vocab.rest / vocab.groups)
    w = Weights(np.log(np.append(mass, vocab.rest) + 1), np.zeros((PREV, classes)), np.zeros((SKIP, classes)),
                np.log(np.append(vocab.counts, groups) + 1), np.zeros((NEAR, m)), np.zeros((FAR, m)))
    if not vocab.tokens:
        return w
    context = F.when(F.col("member"), F.floor(F.col("cell") / m)).otherwise(F.floor(F.col("cell") / (SKIP * classes)))
    # a row for each context; so many partitions hold the whole table, whatever the input
    packed = cells.groupBy("member", context.alias("context")).agg(F.collect_list(F.struct("cell", "n")).alias("x"))
    dealt = settled(packed.select("member", "context", F.col("x.cell").alias("cell"), F.col("x.n").alias("n"))
                    .repartition(PARTS, "member", "context"), "cells")
    sums = [np.full(a.shape, 1e-12) for a in w.arrays()]
    for step in range(steps):
        now = w

        def gradient(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((PREV, SKIP, classes)), np.zeros((NEAR * FAR, m))
            for b in batches:
                for k, cell, n in zip(b["member"], b["cell"], b["n"]):
                    total[int(k)].reshape(-1)[cell] += n
            g = [np.zeros(a.shape) for a in now.arrays()]
            rows = np.flatnonzero(total[0].any(axis=(1, 2)))
            if len(rows):
                t = total[0][rows]
                d = t - t.sum(axis=2, keepdims=True) * np.exp(_class_logs(now, rows))
                g[0], g[2] = d.sum(axis=(0, 1)), d.sum(axis=0)
                g[1][rows] = d.sum(axis=1)
            rows = np.flatnonzero(total[1].any(axis=1))
            if len(rows):
                t = total[1][rows]
                per = t @ (of[:, None] == np.arange(classes))
                d = t - per[:, of] * np.exp(_member_logs(now, rows, of))
                g[3] = d.sum(axis=0)
                np.add.at(g[4], rows // FAR, d)
                np.add.at(g[5], rows % FAR, d)
            yield pd.DataFrame({"part": [np.concatenate([a.reshape(-1) for a in g]).astype("<f4").tobytes()]})
            give_back()

        flat = sum((np.frombuffer(r["part"], "<f4").astype(np.float64)
                    for r in dealt.mapInPandas(gradient, "part binary").collect()), np.zeros(sum(a.size for a in w.arrays())))
        new, at = [], 0
        for a, s in zip(w.arrays(), sums):
            g = flat[at:at + a.size].reshape(a.shape) / vocab.tokens
            at += a.size
            s += g * g
            new.append(a + 0.5 * g / np.sqrt(s) * (1 - step / steps))
        w = Weights(*new)
    return w


def _planes(x: np.ndarray) -> bytes:
    """Numbers, their first bytes, then their second ones and so on: those that are 0 take no room in a shuffle."""
    return x.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def outside(tokens: DataFrame, vocab: Vocabulary) -> DataFrame:
    """The tokens outside the head by group and chunk, some rows of a task: their row
    (twice, plus 1 if it isn't learned from; as differences), key and the hashes before."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0

        def out() -> pd.DataFrame:
            row, key, before, skip = (np.concatenate(x) for x in zip(*held))
            group = vocab.group(key)
            by = np.argsort(group, kind="stable")
            ends = np.cumsum(np.bincount(group, minlength=vocab.groups))
            parts = [(g, by[a:b]) for g, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())) if b > a]
            return pd.DataFrame({"group": [g for g, _ in parts], "chunk": int(row[0] // 2), "row": [_planes(np.diff(row[at], prepend=0)) for _, at in parts],
                                 "key": [key[at].astype("<i8").tobytes() for _, at in parts],
                                 "before": [before[at].tobytes() for _, at in parts], "skip": [skip[at].tobytes() for _, at in parts]})

        for b, keys, begins in _parts(batches):
            at = np.flatnonzero(vocab.ids(keys) < 0)
            if not len(at):
                continue
            row = np.repeat(b["row"].to_numpy(np.int64) * 2 + b["held_out"].ne(False).to_numpy(), np.diff(begins, append=len(keys)))
            before, skip = _contexts(keys, begins)
            held.append((row[at], keys[at], *((x[at] >> np.uint64(16)).astype("<u4") for x in (before, skip))))
            n += len(at)
            if n > HELD:
                yield out()
                held, n = [], 0
                give_back()
        if held:
            yield out()
            held = []
        give_back()

    return tokens.select("row", "held_out", "keys").mapInPandas(run, "group int, chunk long, row binary, key binary, before binary, skip binary")


def _slots(context: np.ndarray, salt: int, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where the feature of a context has its weight, in the part of a table
    that a node has: two places for each of its tokens."""
    h = (context + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)
    return (begins + (h * sizes >> np.uint64(32))).astype(np.int64)


def _choices(place: np.ndarray, c: np.ndarray, before: np.ndarray, skip: np.ndarray, learns: np.ndarray) -> np.ndarray:
    """ln P(word | one of a group's known words, the words before) of each
    token, whose word is at ``place`` (ascending) of the known ones, with their
    counts ``c``; learns from the tokens of ``learns``."""
    logs = np.zeros(len(place))
    depth = max(0, len(c) - 1).bit_length()
    mass = np.append(0, np.cumsum(c + 1.0))
    before, skip = before.astype(np.uint64), skip.astype(np.uint64)
    for level, half in enumerate(1 << k for k in range(depth - 1, -1, -1)):
        low = np.arange(0, len(c), 2 * half)
        middle, high = np.minimum(low + half, len(c)), np.minimum(low + 2 * half, len(c))
        right = mass[high] - mass[middle]
        # as many as the words' counts say, where there is a choice
        bias = np.log(np.maximum(right, 1e-300)) - np.log(mass[middle] - mass[low])
        ends = np.append(0, np.searchsorted(place, high))  # of the tokens of each node
        # some whole nodes at a time, so that their arrays are near; the last one may have no right side
        cuts = np.unique(ends[np.searchsorted(ends, np.arange(0, len(place) + NODES, NODES)).clip(0, len(ends) - 1 - (right[-1] == 0))])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            node, go, learn = place[a:b] // (2 * half), (place[a:b] // half) % 2, learns[a:b]
            begins, sizes = (2 * (ends[node] - a)).astype(np.uint64), (2 * (ends[node + 1] - ends[node])).astype(np.uint64)
            z0, at1, at2 = bias[node], _slots(before[a:b], 2 * level, begins, sizes), _slots(skip[a:b], 2 * level + 1, begins, sizes)
            own1, own2, own0, own = at1[learn], at2[learn], z0[learn], go[learn]
            w1, w2 = np.zeros(2 * len(node)), np.zeros(2 * len(node))
            for _ in range(ROUNDS):
                p = 1 / (1 + np.exp(-(own0 + w1[own1] + w2[own2])))
                g, h = own - p, p * (1 - p)
                # half a step each, as both features are of the same tokens
                w1, w2 = (w + 0.5 * (np.bincount(x, g, len(w)) - PRIOR * w) / (np.bincount(x, h, len(w)) + PRIOR) for w, x in ((w1, own1), (w2, own2)))
            logs[a:b] -= np.logaddexp(0, (1 - 2 * go) * (z0 + w1[at1] + w2[at2]))
    return logs


def _row_sums(of: np.ndarray, known: np.ndarray, logs: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rows, at = np.unique(of, return_inverse=True)
    return rows, np.bincount(at, known, len(rows)).astype(np.int64), np.bincount(at, logs, len(rows)), np.bincount(at, score, len(rows))


def _group_scores(parts: pd.DataFrame) -> pd.DataFrame:
    """Of each chunk of a group: per row (as differences) how many of its tokens
    are known, log10 of their counts + 1, and log10 P(word | group, words before)."""
    row = [np.cumsum(_numbers(x)) for x in parts["row"]]
    ends = np.cumsum([len(x) for x in row])
    row = np.concatenate(row)
    key, before, skip = (np.concatenate([np.frombuffer(x, t) for x in parts[c]]) for c, t in (("key", "<i8"), ("before", "<u4"), ("skip", "<u4")))
    by = np.argsort(key, kind="stable")
    learns = (row % 2 == 0)[by]
    words, word = np.unique(key[by], return_inverse=True)
    c = np.bincount(word, learns, len(words))
    has = c > 0
    known = has[word]
    mass = float((c[has] + 1).sum())
    score = np.full(len(key), -math.log(mass + 1))  # one count for all that is not known
    score[known] = (math.log(mass / (mass + 1)) if mass else 0.0) + _choices(
        (np.cumsum(has) - 1)[word[known]], c[has], before[by][known], skip[by][known], learns[known])
    found = [np.empty(len(key)) for _ in range(3)]  # as the tokens came
    for to, x in zip(found, (known, np.log10(c + 1)[word], score / _LOG10)):
        to[by] = x
    del key, before, skip, by, word, known, score, learns
    sums = [_row_sums(row[a:b] // 2, *(x[a:b] for x in found)) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
    del row, found
    give_back()
    return pd.DataFrame({"chunk": parts["chunk"].to_numpy(), "row": [_planes(np.diff(r, prepend=0)) for r, *_ in sums], "known": [_planes(k) for _, k, *_ in sums],
                         "logs": [x.astype("<f8").tobytes() for *_, x, _ in sums], "score": [x.astype("<f8").tobytes() for *_, x in sums]})


def _chunk_scores(parts: pd.DataFrame) -> pd.DataFrame:
    """row, known, logs, more: the sums over a chunk's groups."""
    row = np.concatenate([np.cumsum(_numbers(x)) for x in parts["row"]])
    known = np.concatenate([_numbers(x) for x in parts["known"]])
    logs, score = (np.frombuffer(b"".join(parts[c]), "<f8") for c in ("logs", "score"))
    return pd.DataFrame(dict(zip(("row", "known", "logs", "more"), _row_sums(row, known, logs, score))))


def scored(docs: DataFrame, held_out: Column) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score; learns from the rows where ``held_out`` (of doc_id) is false."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # names repeat within a text; zstd has them in half the room
    tokens = settled(tokenised(docs.withColumn("held_out", held_out)).withColumn("row", F.monotonically_increasing_id()), "tokens", "zstd")
    training = tokens.where(~F.col("held_out"))
    counts = settled(token_counts(training), "token-counts")
    vocab = vocabulary(counts)
    w = train(gathered(training, vocab), vocab)
    class_logs = np.concatenate([(_class_logs(w, p) / _LOG10).astype(np.float32).reshape(-1) for p in np.split(np.arange(PREV), 16)])
    member_logs = np.concatenate([(_member_logs(w, p, vocab.members) / _LOG10).astype(np.float32).reshape(-1) for p in np.split(np.arange(NEAR * FAR), 16)])
    head_logs, whole = np.log10(vocab.counts + 1.0), math.log10(vocab.tokens + vocab.distinct + 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b, keys, begins in _parts(batches):
            ids, at, of = _cells(keys, begins, vocab)
            inside = ids >= 0
            size = np.diff(begins, append=len(keys))
            heads = np.zeros(len(keys))
            heads[inside] = head_logs[ids[inside]]
            yield pd.DataFrame({
                "row": b["row"].array, "n_tokens": size, "n_known": np.add.reduceat(inside, begins, dtype=np.int64),
                "base_score": np.add.reduceat(heads, begins) - size * whole,
                "score": np.add.reduceat(class_logs[at], begins, dtype=np.float64) + np.add.reduceat(member_logs[of], begins, dtype=np.float64),
                "doc_id": b["doc_id"].astype("Int64").array, "held_out": b["held_out"].array})

    first = settled(tokens.mapInPandas(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, row long"), "scores")
    more = (outside(tokens, vocab).groupBy("group").applyInPandas(_group_scores, "chunk long, row binary, known binary, logs binary, score binary")
            .groupBy("chunk").applyInPandas(_chunk_scores, "row long, known long, logs double, more double"))
    return first.join(more, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("logs", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"))


def held_out_sevenths() -> Column:
    return fold_of(F.col("doc_id"), 7) == 2
