"""Removal of repeated passages against brute force: copies, shared passages,
repeats inside a document, hot anchors, small shards and chunks, odd rows."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from newsdesk.llm import suffix_dedup
from newsdesk.llm.suffix_dedup import Automaton

SCHEMA = "doc_id long, text string, doc string, th int, start int, end string, spans int, kept string, shard long"


def brute(rows, window):
    """rows: (doc_id, text), each doc_id with one text."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = (text or "").encode().split()
        stay = [True] * len(words)
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            if w in seen:
                stay[i:i + window] = [False] * window
            seen.add(w)
        out[doc] = (len(words), len(words) - sum(stay), b" ".join(w for w, k in zip(words, stay) if k).decode())
    return out


def documents(seed):
    rng = random.Random(seed)
    prose = lambda n: " ".join(f"w{rng.randint(0, 400)}" for _ in range(n))
    passage, texts = prose(60), []
    for k in range(90):
        t = prose(rng.randint(0, 80))
        if rng.random() < 0.5:
            t = f"{t} \n{passage}\x0b{prose(rng.randint(0, 30))}"  # one passage in many contexts
        if texts and rng.random() < 0.3:
            old = rng.choice(texts).split()
            if old:
                old[rng.randrange(len(old))] = "changed"
                t = " ".join(old)
        if rng.random() < 0.1:
            t = f"{t} {t}"
        texts.append(t)
    texts += ["a " * 300, "a " * 30, "x y " * 100, "", "  \t", "é è " * 50, "one " + passage]
    return [(7 * i % 997, t) for i, t in enumerate(texts)] + [(None, texts[3]), (1000, None), (-5, texts[5])]


@pytest.mark.parametrize("seed,hot,shard,chunk,window", [(1, 4096, 2048, 10**6, 20), (2, 40, 8, 500, 20), (3, 4096, 1, 100, 5), (4, 1, 64, 1000, 3)])
def test_against_brute_force(spark, monkeypatch, seed, hot, shard, chunk, window):
    monkeypatch.setattr(suffix_dedup, "SAMPLE", 1)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "SHARD", shard)
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    rows = documents(seed)
    df = spark.createDataFrame([(d, t, "x", 1, 1, "x", 1, "x", 1) for d, t in rows], SCHEMA).repartition(5)
    got = suffix_dedup.deduplicated(df, window).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == brute(rows, window)


def test_repeated_rows(spark):
    """Rows with equal id and text are one document; with another text, two."""
    t = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, t), (1, t), (2, t), (3, t + " a"), (3, "b " + t)], "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in suffix_dedup.deduplicated(df).collect())
    assert got == [(1, 30, 0), (1, 30, 0), (2, 30, 30), (3, 31, 30), (3, 31, 30)]
    assert suffix_dedup.deduplicated(df.where("false")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=12), min_size=1, max_size=6), st.integers(1, 4))
def test_automaton(sequences, window):
    a = Automaton()
    for k, s in enumerate(sequences):
        a.add(s, k)
    for k, s in enumerate(sequences):
        earlier = {tuple(t[i:i + window]) for t in sequences[:k] for i in range(len(t) - window + 1)}
        assert a.earlier(s, k, window) == [i for i in range(window - 1, len(s)) if tuple(s[i - window + 1:i + 1]) in earlier]


def test_segments_cover_each_window_once():
    texts = ["a b c d e f g h i j " * 5, "", "a b", " ".join(f"w{i}" for i in range(100))]
    s = suffix_dedup.segments(texts, 20, np.empty(0, np.uint64))
    got = sorted((r, i) for r, at, n in zip(s["row"].tolist(), s["start"].tolist(), s["n"].tolist()) for i in range(at, at + n))
    assert got == [(r, i) for r, t in enumerate(texts) for i in range(len(t.split()) - 19)]
