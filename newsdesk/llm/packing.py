"""Best-fit packing: documents into as few fixed-length sequences as can be.

Documents are encoded and cut into pieces of at most ``capacity`` tokens (only
longer ones are cut; an end id closes each). The histogram of piece lengths,
at most ``capacity`` rows at any input size, is all that the driver sees. On
it the configuration linear program (patterns of lengths that fit a sequence,
least number of patterns that covers every length) is solved by multiplicative
weights, a knapsack by dynamic programming pricing each step; the solution is
rounded down and what is left is filled greedily, pattern by pattern, each
used as often as the counts allow. Every piece then finds its place by its
rank among the pieces of its length; ranks are taken in salted buckets, so a
length that a third of all pieces has is no single task's work.

Defined results: null text is empty, and an empty text is one piece holding
the end id; repeated rows are packed as often as they occur; a null doc_id
stays null; no rows give no rows. Columns other than doc_id and text are not
read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from newsdesk.llm.common import partitions, settled
from newsdesk.llm.tokens import as_array, encoder

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """The pieces of every document with the crc32 of their ids."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for b in batches:
            out = []
            for doc_id, text in zip(b["doc_id"].tolist(), b["text"].tolist()):
                ids = enc.ids(text) + end
                out += [(doc_id, k, at // 4, len(part) // 4, zlib.crc32(part))
                        for k, at in enumerate(range(0, len(ids), 4 * capacity))
                        for part in (ids[at:at + 4 * capacity],)]
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield frame.assign(doc_id=frame["doc_id"].astype("Int64"))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(cut, PIECES)


@dataclass
class Plan:
    """Patterns: lengths (with repeats) and how many sequences use each."""
    patterns: list[tuple[int, ...]]
    times: list[int]
    lower_bound: float


def _knapsack(value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: its value, and its count of each length."""
    best, pick = np.zeros(capacity + 1), np.zeros(capacity + 1, int)
    for c in range(1, capacity + 1):
        got = best[c - 1::-1][:c] + value[1:c + 1]  # length l leaves c - l
        l = int(got.argmax())
        best[c], pick[c] = (got[l], l + 1) if got[l] > best[c - 1] else (best[c - 1], 0)
    counts, c = np.zeros(capacity + 1, int), capacity
    while c > 0:
        l = pick[c]
        counts[l] += l > 0
        c -= l or 1
    return float(best[capacity]), counts


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = 150, rate: float = 1.0) -> Plan:
    """Solve and round the configuration program. ``rounds`` bounds the number
    of priced patterns; the fill adds a few thousand at most, as each of its
    patterns uses up a length. The fractional solution is scaled by a few
    factors before it is rounded down, and the rounding with the fewest
    sequences is taken."""
    need = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        need[length] = n
    # a piece that fills a sequence has but one pattern
    alone, need[capacity] = int(need[capacity]), 0
    used, bound = _solve(need, capacity, rounds, rate)
    best: dict[tuple[int, ...], int] | None = None
    for scale in (1.0, 0.8, 0.6, 0.4):
        times, left = {}, need.copy()
        for key, x in sorted(used.items(), key=lambda kv: (-kv[1] * sum(kv[0]), kv[0])):
            lengths, k = np.unique(key, return_counts=True)
            n = int(min(np.floor(x * scale), (left[lengths] // k).min()))
            # a pattern that leaves much room waits for the fill
            if n > 0 and sum(key) >= capacity - capacity // 128:
                times[key] = times.get(key, 0) + n
                left[lengths] -= n * k
        for key, n in _fill(left, capacity):
            times[key] = times.get(key, 0) + n
        if best is None or sum(times.values()) < sum(best.values()):
            best = times
    if alone:
        best[(capacity,)] = alone
    return Plan(list(best), list(best.values()), alone + bound)


def _solve(need: np.ndarray, capacity: int, rounds: int, rate: float) -> tuple[dict[tuple[int, ...], float], float]:
    """Multiplicative weights on the covering program: lengths that lag behind
    gain weight, the knapsack finds the pattern worth most under the weights.
    Returns the patterns' fractional use, scaled to the demand, and the best
    lower bound that the weights gave (any weights give one by duality)."""
    has, used = np.flatnonzero(need), {}
    if not len(has):
        return used, 0.0
    covered = np.zeros(capacity + 1)
    bound = float((need * np.arange(capacity + 1)).sum()) / capacity
    for _ in range(rounds):
        ratio = covered[has] / need[has]
        value = np.zeros(capacity + 1)
        value[has] = np.exp(-rate * (ratio - ratio.min()) * len(has) ** 0.5) / need[has]
        top, counts = _knapsack(value, capacity)
        bound = max(bound, float((value * need).sum()) / top)
        counts = np.minimum(counts, need)
        took = counts > 0
        step = float((need[took] / counts[took]).min())
        covered += step * counts
        key = tuple(np.repeat(np.flatnonzero(took), counts[took]).tolist())
        used[key] = used.get(key, 0.0) + step
    scale = 1 / max(1.0, float(np.median(covered[has] / need[has])))
    return {k: x * scale for k, x in used.items()}, bound


def _fill(left: np.ndarray, capacity: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Best fit on what is left: the longest piece, then the set of remaining
    lengths that fills its sequence best, used as often as the counts allow."""
    while len(rest := np.flatnonzero(left)):
        first = int(rest[-1])
        room, key, free = capacity - first, [first], left.copy()
        free[first] -= 1
        fits = np.flatnonzero(free[:room + 1])
        # exact pairs first, else the longest that fits, again and again
        while len(fits):
            l = int(fits[-1])
            if l < room:
                pair = fits[(free[room - fits] > (fits * 2 == room)) & (fits < room)]
                if len(pair):
                    key += [int(pair[-1]), room - int(pair[-1])]
                    break
            key.append(l)
            free[l] -= 1
            room -= l
            fits = np.flatnonzero(free[:room + 1])
        lengths, k = np.unique(key, return_counts=True)
        n = int((left[lengths] // k).min())
        left[lengths] -= n * k
        yield tuple(sorted(key)), n


def _segments(p: Plan) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: the ranks each pattern takes, and where they go."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    base = 0
    for key, n in zip(p.patterns, p.times):
        lengths, k = np.unique(key, return_counts=True)
        at = 0
        for l, c in zip(lengths.tolist(), k.tolist()):
            seen = rows.setdefault(l, [])
            begin = seen[-1][4] if seen else 0
            seen.append((begin, c, base, at, begin + c * n))
            at += l * c
        base += n
    return {l: tuple(np.array(x, np.int64) for x in zip(*r)) for l, r in rows.items()}


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cut = settled(pieces(docs, path, capacity, end_id), "pieces")
    return place(cut, plan({r[0]: r[1] for r in cut.groupBy("length").count().collect()}, capacity), partitions(spark))


def place(cut: DataFrame, p: Plan, buckets: int) -> DataFrame:
    """Give every piece its sequence and offset under the plan."""
    where = _segments(p)
    salted = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    key = ["length", "_bucket"]
    before = (salted.groupBy(*key).count().select(
        *key, (F.sum("count").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("count")).alias("_before")))
    ranked = (salted.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy("doc_id", "piece")) - 1)
              .join(before, key).withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_bucket", "_before"))

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seq, off = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            rank, length = b["_rank"].to_numpy(), b["length"].to_numpy()
            for l in np.unique(length):
                at = np.flatnonzero(length == l)
                begin, per, base, start, _ = where[int(l)]
                i = np.searchsorted(begin, rank[at], "right") - 1
                k = rank[at] - begin[i]
                seq[at], off[at] = base[i] + k // per[i], start[i] + (k % per[i]) * l
            yield b.drop(columns="_rank").assign(sequence_id=seq, offset=off)

    return ranked.select(*cut.columns, "_rank").mapInPandas(put, PIECES + ", sequence_id long, offset long")
