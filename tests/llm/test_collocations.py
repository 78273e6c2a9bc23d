"""Phrase collocations against brute force: languages, nulls, pieces, ties,
overlaps, any number of shards, crowded bitmaps and small chunks."""

import random
import re
from collections import Counter, defaultdict

import pytest

from newsdesk.llm import collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, n int, since int, shard string, words int, a string"


def brute(rows, threshold, top):
    f, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            f[lang].update(tuple(w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        own = {p: a for p, a in counts.items() if len(p) > 1 and a >= threshold}
        scored = []
        for p, a in own.items():
            inside = [b for q, b in own.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= 80 * a for b in inside):
                continue
            score, cut = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:cut]], counts[p[cut:]]))
        for rank, (score, a, p, x, y) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, x, y, total[lang], -score))
    return sorted(out)


def documents(seed):
    rng = random.Random(seed)
    said = ["New york City", "of the", "a b a b", "été  à\tParis", "one two three four five", "ＡA É"]
    rows = []
    for k in range(260):
        words = [rng.choice([rng.choice("abcdefgh"), rng.choice(said), f"w{rng.randint(0, 30)}"]) for _ in range(rng.randint(0, 40))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", ", ", "\n", ".", "\x0b", " ?! "]) for w in words)
        rows.append((k, text, rng.choice(["en", "en", "en", "de", None, "und", ""])))
    return rows + [(None, "a b " * 500, "en"), (3, None, "en"), (3, "", "fr"), (4, "x\x00y z " * 40, "en"), (4, "x\x00y z " * 40, "en"), (5, "  \t", "de")]


@pytest.mark.parametrize("seed,shards,bits,tokens,threshold,top", [
    (1, 3, 26, 10**6, 30, 2000), (2, 1, 10, 200, 8, 2000), (3, 4, 8, 10**6, 5, 7), (4, 2, 6, 500, 30, 50)])
def test_against_brute_force(spark, monkeypatch, seed, shards, bits, tokens, threshold, top):
    monkeypatch.setattr(collocations, "BITS", bits)
    monkeypatch.setattr(collocations, "TOKENS", tokens)
    rows = documents(seed)
    df = spark.createDataFrame([(*r, "x", 1, 1, "x", 1, "x") for r in rows], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in collocations.collocations(df, threshold, top, shards).collect())
    assert got == brute(rows, threshold, top) and got


def test_no_rows(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_scans_sum_counts_after_the_shuffle_alone(spark, monkeypatch):
    plans, real = [], collocations.settled

    def settled(df, name):
        if name.startswith("scan"):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(collocations, "settled", settled)
    rows = [("né b c", "é"), ("né b", "é"), ("a b", None), ("a b", None)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = {tuple(r) for r in collocations.frequent(docs, threshold=2).collect()}
    assert got == {("é", "", 5), ("é", "né", 2), ("é", "b", 2), ("é", "né b", 2), ("und", "", 4), ("und", "a", 2), ("und", "b", 2), ("und", "a b", 2)}
    assert plans and all(p.index("partial_sum") < p.index("hashpartitioning(lang") for p in plans)
