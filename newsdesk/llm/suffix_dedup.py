"""Removal of repeated passages by suffix automata of reference shards.

Words are runs of characters other than ASCII white space. A window is
``window`` consecutive words of one document; a word goes if a window that covers
it has the words of one that starts earlier (smaller doc_id, or same document
and earlier start). Windows are judged on the input.

A shard need only meet the text that can match it, so text is routed by content:

1. Of a window's runs of ``GRAM`` words, the one with the least hash (the first
   of those) is its anchor. Neighbouring windows with one anchor are a segment,
   a stretch of ``window`` to 2 * ``window`` - ``GRAM`` words. Equal windows
   have equal anchors, so they lie in segments of one anchor. Equal segments
   are one class: its first segment stays with the class, the others have all
   their windows earlier and go whole. Copies are so found in the task that
   reads them, and one row for each class leaves it.
2. Anchors with more than one class are dealt to reference shards of about
   ``SHARD`` segments, in the order of documents. Each shard gets the suffix
   automaton of its segments, whose states know the first place of their words,
   and all segments of its anchors stream past it: the matching statistics say
   at each word how much of what was just read occurs in the shard, and from
   ``window`` words on, where first. Maximal runs of windows that occur earlier
   are the spans to remove. A class that is alone with its anchor equals nothing
   else and needs no automaton. An automaton meets its segments in one task and
   is not sent to any other, as no text elsewhere can match it: nothing is
   broadcast that grows.
3. The spans meet their documents.

An anchor inside a very common passage has a class for each context of the
passage. Anchors that a sample of documents (``SAMPLE``) shows to have more than
about ``HOT`` classes (the ``MOST`` most frequent of them, the only thing the
driver sees) are not used: their windows are routed by all their words. The
sample decides the route alone; the result is the same for any list.

Hashes of 64 bits or more are taken as equal when they agree.

Defined results: null, empty and short texts lose nothing; a null doc_id comes
before all others; rows with equal doc_id and text are one document, and each
gets its result; rows that repeat a doc_id with another text are documents of
their own, in the order of a hash of the text; no rows give no rows. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from newsdesk.llm.common import partitions, settled
from newsdesk.llm.neardup import _WORDS, _mixed

WINDOW, GRAM = 20, 4
SHARD = 2048
SAMPLE, HOT, MOST = 64, 4096, 65536
CHUNK = 2_000_000  # segments that a task holds before it deals them out
_NULL = -2 ** 63
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEGMENT = [("h", "<u8"), ("key", "<u8"), ("doc", "<i8"), ("th", "<u4"), ("start", "<u4"), ("n", "<u2")]
_SPAN = [("doc", "<i8"), ("th", "<u4"), ("start", "<u4"), ("end", "<u4")]


def keyed(docs: DataFrame) -> DataFrame:
    """doc and th (what tells documents apart and orders them), and the text."""
    text = F.col("text").cast("string")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL)).alias("doc"),
                       F.xxhash64(text).bitwiseAND(0xFFFFFFFF).alias("th"), F.coalesce(text, F.lit("")).alias("text"))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of _BASE modulo 2**64, and of its inverse."""
    inverse = np.uint64(pow(int(_BASE), -1, 2 ** 64))
    return tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, b, np.uint64))]) for b in (_BASE, inverse))


def _pack(rows: dict[str, np.ndarray], kind: list) -> bytes:
    return b"".join(rows[c].astype(t).tobytes() for c, t in kind)


def _unpack(blobs: list[bytes], kind: list) -> dict[str, np.ndarray]:
    width = sum(np.dtype(t).itemsize for _, t in kind)
    parts: dict[str, list] = {c: [] for c, _ in kind}
    for b in blobs:
        n, at = len(b) // width, 0
        for c, t in kind:
            parts[c].append(np.frombuffer(b, t, n, at))
            at += n * np.dtype(t).itemsize
    return {c: np.concatenate(parts[c]) if parts[c] else np.empty(0, t) for c, t in kind}


def segments(texts: list[str], window: int, hot: np.ndarray) -> dict[str, np.ndarray]:
    """The segments of some texts: row (place of the text), h (anchor), key
    (words), start (word), n (windows)."""
    words = [t.encode("utf-8", "replace").split() for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    total = int(sizes.sum())
    empty = {c: np.empty(0, np.int64) for c in ("row", "h", "key", "start", "n")}
    if total < window:
        return empty
    w = np.fromiter(map(_WORDS.__getitem__, chain.from_iterable(words)), np.uint64, total)
    row = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    gram = min(GRAM, window)
    g = np.zeros(total - gram + 1, np.uint64)
    for i in range(gram):
        g = _mixed((g ^ w[i:len(g) + i]) * _BASE)
    span = window - gram + 1
    anchor = np.lib.stride_tricks.sliding_window_view(g, span).argmin(axis=1) + np.arange(len(g) - span + 1)
    whole = row[:len(anchor)] == row[window - 1:]  # windows of one text
    begins = whole.copy()
    begins[1:] &= ~whole[:-1] | (anchor[1:] != anchor[:-1])
    at = np.flatnonzero(begins)
    if not len(at):
        return empty
    # a segment ends before the next begins, or at its text's last window
    n = np.minimum(np.r_[at[1:], total], (first + sizes)[row[at]] - window + 1) - at
    h = g[anchor[at]]
    if len(hot):  # by the windows themselves
        split = np.isin(h, hot)
        if split.any():
            k = n[split]
            each = np.repeat(at[split] - (np.cumsum(k) - k), k) + np.arange(k.sum())
            at, n = np.concatenate([at[~split], each]), np.concatenate([n[~split], np.ones(len(each), np.int64)])
            h = np.concatenate([h[~split], np.zeros(len(each), np.uint64)])
    power, inverse = _powers(1 << max(16, total.bit_length()))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(w * power[:total])])
    length = n + window - 1
    key = _mixed(((sums[at + length] - sums[at]) * inverse[at]) ^ (length.astype(np.uint64) << np.uint64(56)))
    if len(hot):
        h = np.where(h == 0, _mixed(key * _BASE), h)
    return {"row": row[at], "h": h, "key": key, "start": at - first[row[at]], "n": n}


def _classes(s: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For segments in the order of documents: an order in which classes come
    together, their first segment first, and where classes begin in it."""
    order = np.argsort(_mixed(s["h"] ^ (s["key"] * _BASE)), kind="stable")
    h, key = s["h"][order], s["key"][order]
    new = np.ones(len(order), bool)
    new[1:] = (h[1:] != h[:-1]) | (key[1:] != key[:-1])
    return order, new


def _merged(doc: np.ndarray, th: np.ndarray, start: np.ndarray, end: np.ndarray) -> dict[str, np.ndarray]:
    """Spans joined where they overlap or meet; ends rise with starts."""
    order = np.lexsort((start, th, doc))
    doc, th, start, end = doc[order], th[order], start[order], end[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (th[1:] != th[:-1]) | (start[1:] > end[:-1])
    at = np.flatnonzero(new)
    last = np.r_[at[1:], len(doc)] - 1
    return {"doc": doc[at], "th": th[at], "start": start[at], "end": end[last]} if len(at) else {"doc": doc, "th": th, "start": start, "end": end}


def _dealt(window: int, hot, parts: int):
    """(p, kind, blob): a task's classes by anchor, and its copies' spans."""
    def flush(held: list[dict]) -> Iterator[pd.DataFrame]:
        s = {c: np.concatenate([x[c] for x in held]) for c in held[0]}
        order = np.lexsort((s["start"], s["th"], s["doc"]))
        s = {c: v[order] for c, v in s.items()}
        order, new = _classes(s)
        s = {c: v[order] for c, v in s.items()}
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]  # each segment's first of its class
        later = (s["doc"] != s["doc"][lead]) | (s["th"] != s["th"][lead]) | (s["start"] != s["start"][lead])
        gone = _merged(s["doc"][later], s["th"][later], s["start"][later], s["start"][later] + s["n"][later] + window - 1)
        kept = {c: v[new] for c, v in s.items()}
        for kind, name, rows, p in ((_SEGMENT, "segment", kept, (kept["h"] >> np.uint64(7)) % np.uint64(parts)),
                                    (_SPAN, "span", gone, _mixed(gone["doc"].astype(np.uint64) * _BASE) % np.uint64(parts))):
            if not len(p):
                continue
            order = np.argsort(p, kind="stable")
            groups = np.split(order, np.flatnonzero(np.diff(p[order].astype(np.int64))) + 1)
            yield pd.DataFrame({"p": [int(p[g[0]]) for g in groups], "kind": [name] * len(groups),
                                "blob": [_pack({c: v[g] for c, v in rows.items()}, kind) for g in groups]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for b in batches:
            s = segments(b["text"].tolist(), window, hot.value)
            row = s.pop("row")
            if not len(row):
                continue
            held.append(s | {"doc": b["doc"].to_numpy()[row], "th": b["th"].to_numpy()[row]})
            n += len(row)
            if n >= CHUNK:
                yield from flush(held)
                held, n = [], 0
        if n:
            yield from flush(held)
    return run


def _judged(window: int):
    """(doc, th, start, end, shard) of a range of anchors: copies' spans without
    a shard; the first segments of the classes whose anchor has several."""
    def group(p: int, blobs: dict[str, list[bytes]]) -> Iterator[pd.DataFrame]:
        gone = _unpack(blobs["span"], _SPAN)
        yield pd.DataFrame(gone).assign(shard=pd.array([pd.NA] * len(gone["doc"]), "Int64"))
        s = _unpack(blobs["segment"], _SEGMENT)
        order = np.lexsort((s["start"], s["th"], s["doc"]))
        s = {c: v[order] for c, v in s.items()}
        order, new = _classes(s)
        s = {c: v[order] for c, v in s.items()}
        s["end"] = s["start"] + s["n"] + (window - 1)
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        later = (s["doc"] != s["doc"][lead]) | (s["th"] != s["th"][lead]) | (s["start"] != s["start"][lead])
        yield pd.DataFrame({c: s[c][later] for c, _ in _SPAN}).assign(shard=pd.array([pd.NA] * int(later.sum()), "Int64"))
        one = {c: v[new] for c, v in s.items()}
        _, anchor, classes = np.unique(one["h"], return_inverse=True, return_counts=True)
        several = np.where(classes > 1, classes, 0)
        bin_of = (np.cumsum(several) - several) // SHARD  # an anchor's classes are in one shard
        ask = several[anchor] > 0
        yield pd.DataFrame({c: one[c][ask] for c, _ in _SPAN}).assign(shard=(p << 32) + bin_of[anchor][ask])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, blobs = None, {"segment": [], "span": []}
        for b in batches:
            for p, kind, blob in zip(b["p"].tolist(), b["kind"].tolist(), b["blob"].tolist()):
                if at is not None and p != at:
                    yield from group(at, blobs)
                    blobs = {"segment": [], "span": []}
                at = p
                blobs[kind].append(blob)
        if at is not None:
            yield from group(at, blobs)
    return run


class Automaton:
    """The suffix automaton of word sequences, given in order. ``first`` has,
    for each state, which of them holds its words first."""

    def __init__(self) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [-1]

    def _state(self, next_: dict, link: int, length: int, first: int) -> int:
        self.next.append(next_)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.next) - 1

    def _split(self, p: int, word: str, q: int) -> int:
        """The state of q's words that end p's with the word: q, or a copy of
        it that takes the shorter ones over."""
        if self.length[p] + 1 == self.length[q]:
            return q
        clone = self._state(self.next[q].copy(), self.link[q], self.length[p] + 1, self.first[q])
        self.link[q] = clone
        next_ = self.next
        while p != -1 and next_[p].get(word) == q:
            next_[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[str], number: int) -> None:
        next_, link, last = self.next, self.link, 0
        for word in words:
            q = next_[last].get(word)
            if q is not None:
                last = self._split(last, word, q)
                continue
            new = self._state({}, 0, self.length[last] + 1, number)
            p = last
            while p != -1 and word not in next_[p]:
                next_[p][word] = new
                p = link[p]
            if p != -1:
                link[new] = self._split(p, word, next_[p][word])
            last = new

    def earlier(self, words: list[str], number: int, window: int) -> list[int]:
        """The places in ``words`` where a window ends that a sequence before
        ``number`` holds, by matching statistics: of what was read last, the
        longest part that occurs in the shard (``window`` words are enough)."""
        next_, link, length, first = self.next, self.link, self.length, self.first
        state, matched, found = 0, 0, []
        for i, word in enumerate(words):
            while state and word not in next_[state]:
                state = link[state]
                matched = length[state]
            state = next_[state].get(word, 0)
            matched = matched + 1 if state else 0
            if matched >= window:
                while length[link[state]] >= window:
                    state = link[state]
                matched = window
                if first[state] < number:
                    found.append(i)
        return found


def _matched(window: int):
    """(doc, th, start, end) of the spans that a shard's segments lose."""
    def shard(rows: list[tuple]) -> pd.DataFrame:
        texts = [r[3].split(" ") for r in rows]
        automaton, out = Automaton(), []
        for number, words in enumerate(texts):
            automaton.add(words, number)
        for number, (words, (doc, th, start, _)) in enumerate(zip(texts, rows)):
            span = None
            for i in automaton.earlier(words, number, window):
                low, high = start + i + 1 - window, start + i + 1
                if span and low <= span[3]:
                    span[3] = high
                else:
                    span = [doc, th, low, high]
                    out.append(span)
        return pd.DataFrame(out, columns=["doc", "th", "start", "end"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, rows = None, []
        for b in batches:
            for s, *row in zip(b["shard"].tolist(), b["doc"].tolist(), b["th"].tolist(), b["start"].tolist(), b["words"].tolist()):
                if s != at and rows:
                    yield shard(rows)
                    rows = []
                at = s
                if not rows or rows[-1][:3] != tuple(row[:3]):  # not the same document again
                    rows.append(tuple(row))
        if rows:
            yield shard(rows)
    return run


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words of the segments that were asked for."""
    for b in batches:
        out = []
        for doc, th, text, asked in zip(b["doc"].tolist(), b["th"].tolist(), b["text"].tolist(), b["asked"].tolist()):
            words = text.encode("utf-8", "replace").split()
            out += [(a["shard"], doc, th, a["start"], b" ".join(words[a["start"]:a["end"]]).decode()) for a in asked]
        if out:
            yield pd.DataFrame(out, columns=["shard", "doc", "th", "start", "words"])


def _cleaned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        n_words, n_removed, kept = [], [], []
        for text, spans in zip(b["text"].tolist(), b["spans"].tolist()):
            words = text.encode("utf-8", "replace").split()
            n_words.append(len(words))
            if spans is not None and len(spans):
                stay = np.ones(len(words), bool)
                for s in spans:
                    stay[s["start"]:s["end"]] = False
                words = [words[i] for i in np.flatnonzero(stay).tolist()]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words).decode())
        if kept:
            yield pd.DataFrame({"doc": b["doc"], "n_words": n_words, "n_removed": n_removed, "kept": kept})


def _hot(texts: DataFrame, window: int) -> np.ndarray:
    """Anchors that a sample of the documents shows to have very many classes."""
    none = np.empty(0, np.uint64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = segments(b["text"].tolist(), window, none)
            yield pd.DataFrame({"h": s["h"].astype(np.uint64).view(np.int64), "key": s["key"].astype(np.uint64).view(np.int64)})

    seen = texts.where(F.pmod(F.xxhash64("doc", "th"), F.lit(SAMPLE)) == 0).mapInPandas(run, "h long, key long").distinct()
    rows = (seen.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") * SAMPLE > HOT)
            .orderBy(F.desc("n"), "h").limit(MOST).collect())
    return np.array(sorted(r.h for r in rows), np.int64).view(np.uint64)


def repeated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, th, start, end): spans of words that repeat earlier text. They
    may overlap."""
    spark, texts = docs.sparkSession, keyed(docs)
    hot = spark.sparkContext.broadcast(_hot(texts, window))  # at most MOST numbers
    parts = partitions(spark)
    dealt = (texts.mapInPandas(_dealt(window, hot, 2 * parts), "p int, kind string, blob binary")
             .repartition(parts, "p").sortWithinPartitions("p"))
    judged = settled(dealt.mapInPandas(_judged(window), "doc long, th long, start int, end int, shard long"), "segments")
    asked = judged.where("shard is not null").groupBy("doc", "th").agg(F.collect_list(F.struct("start", "end", "shard")).alias("asked"))
    cut = texts.join(asked, ["doc", "th"]).select("doc", "th", "text", "asked").mapInPandas(
        _cut, "shard long, doc long, th long, start int, words string")
    matched = (cut.repartition(parts, "shard").sortWithinPartitions("shard", "doc", "th", "start")
               .mapInPandas(_matched(window), "doc long, th long, start int, end int"))
    return judged.where("shard is null").select("doc", "th", "start", "end").unionByName(matched)


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept (the words that
    stay, joined by one space)."""
    spans = settled(repeated(docs, window), "spans").groupBy("doc", "th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    out = (keyed(docs).join(spans, ["doc", "th"], "left").select("doc", "text", "spans")
           .mapInPandas(_cleaned, "doc long, n_words long, n_removed long, kept string"))
    return out.select(F.when(F.col("doc") != _NULL, F.col("doc")).alias("doc_id"), "n_words", "n_removed", "kept")
