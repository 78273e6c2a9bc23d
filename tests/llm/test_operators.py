"""Small fixtures with nulls, empty and long texts, repeated rows and clashing
columns, held against brute force; empty tables for every operator."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newsdesk.llm import (bpe_tree, language_model, licenses, neardup, packing, quality, quotes, search, token_files, tokens,
                          toxicity)

WORD, BYTE = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))
LONG = " ".join(f"w{i % 977} run{i % 13}" for i in range(9000))
TEXTS = [
    (0, "the quick brown fox jumps over the lazy dog again and again " * 6), (1, None), (2, ""), (3, "  \n\t "), (4, "one two"),
    (5, "one two"), (6, LONG), (7, LONG + " tail"), (8, "A b\nA b\nc # $ d\x0be <|endoftext|> l’été Ⅷ²"), (8, "A b\nA b\nc # $ d\x0be <|endoftext|> l’été Ⅷ²"),
    (None, "no id at all"), (9, "日本語のテキスト" * 3000), (10, "<|startoftext|>  x"), (11, "a" * 40000),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "en", "s", 0, "clash", 1) for d, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, n_words int")


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="abehinorst'é 1.", min_size=1, max_size=60), min_size=2, max_size=9))
def test_tree_concatenation_is_exact(parts):
    runs = bpe_tree.Runs(WORD)
    for text in ("".join(parts), "".join(re.sub(r"[^a-zé]", "", p) * 40 for p in parts)):
        cut = max(1, len(text) // 7)
        pieces = [text[i:i + cut] for i in range(0, len(text), cut)]
        got = bpe_tree.concatenated(runs, [(p, runs.enc.ids(p)) for p in pieces])
        assert tokens.as_array(got).tolist() == runs.enc.tokenizer.encode(text, add_special_tokens=False).ids


def test_round_trip(docs, none):
    t = Tokenizer.from_file(WORD)
    got = sorted((str(r.doc_id), bytes(r.ids), r.decoded) for r in bpe_tree.encode_and_decode(docs, WORD).collect())
    want = []
    for d, text in TEXTS:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want.append((str(d), np.array(ids, "<u4").tobytes(), t.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)
    assert bpe_tree.encode_and_decode(none, WORD).count() == 0


def test_blocks_and_checkpoints():
    rng = np.random.default_rng(0)
    ids = rng.zipf(1.3, 70_000).clip(0, 5000).astype(np.uint32)
    table = token_files.Table(token_files.scaled(np.bincount(ids)))
    block, symbols = token_files.encode_block(ids, table, 64, 100), table.symbols()
    assert (token_files.decode_block(block, table, symbols) == ids).all()
    assert (token_files.decode_block(block, table, symbols, 2, 4) == ids[2 * 6400:4 * 6400]).all()
    with pytest.raises(ValueError):
        token_files.decode_block(block[:100] + b"\0\0" + block[102:], table, symbols)


def test_token_files(spark, docs, none, tmp_path):
    token_files.write(docs, BYTE, f"{tmp_path}/a")
    got = [(r.doc_id, r.start, tokens.as_array(bytes(r.ids)).tolist()) for r in token_files.read(spark, f"{tmp_path}/a").orderBy("start").collect()]
    t, start = Tokenizer.from_file(BYTE), 0
    assert [g[0] for g in got] == sorted((d for d, _ in TEXTS), key=lambda d: (d is not None, d))
    want = {d: t.encode(x or "", add_special_tokens=False).ids + [2] for d, x in TEXTS}
    for d, at, ids in got:
        assert at == start and ids == want[d]
        start += len(ids)
    token_files.write(none, BYTE, f"{tmp_path}/b")
    assert token_files.read(spark, f"{tmp_path}/b").count() == 0


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20))
def test_plan_covers_each_length(histogram):
    p = packing.plan(histogram, 64, rounds=20)
    used = Counter()
    for key, n in zip(p.patterns, p.times):
        assert sum(key) <= 64
        used.update({k: c * n for k, c in Counter(key).items()})
    assert used == Counter(histogram)
    assert sum(p.times) >= p.lower_bound - 1e-6 and sum(p.times) <= 1.5 * p.lower_bound + 1


def test_pack(docs, none):
    rows = packing.pack(docs, WORD, 256).collect()
    t = Tokenizer.from_file(WORD)
    want = Counter()
    for d, x in TEXTS:
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        want.update((d, k, at, len(ids[at:at + 256]), zlib.crc32(np.array(ids[at:at + 256], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 256)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == by.get(r.sequence_id, 0)
        by[r.sequence_id] = r.offset + r.length
    assert max(by.values()) <= 256
    assert packing.pack(none, WORD).count() == 0


def test_quality_counts(docs, none, spark):
    got = sorted((str(r.doc_id), *(r[c] for c in quality.COUNTS), r.base_failed) for r in quality.measured(docs).collect())
    want = []
    for d, text in TEXTS:
        w, x = words(text), text or ""
        win = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        c = Counter(win)
        cover = {j for i, y in enumerate(win) if c[y] > 1 for j in (i, i + 1, i + 2)}
        lines = [line for line in x.split("\n") if words(line)]
        want.append((str(d), len(w), sum(map(len, w)), sum(ch in quality.SYMBOLS for ch in x), len(lines) - len(set(lines)), len(cover),
                     len(w) < 50 or 100 * len(cover) > 50 * len(w)))
    assert got == sorted(want)
    labels = spark.createDataFrame([(0, 1, 0), (None, 1, 0), (4, None, None), (5, 0, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.decide(docs, labels).count() == len(TEXTS)
    assert quality.keep(docs, labels).columns == docs.columns
    assert quality.decide(none, labels).count() == 0 and quality.decide(docs, labels.where("false")).count() == len(TEXTS)


def test_binomial_tail_and_cutoffs(spark):
    rows = spark.createDataFrame([(k, n) for n in (30, 500, 4000) for k in range(0, n // 100)] + [(0, 1000)], "k long, n long")
    for r in rows.select("k", "n", quality._tail(F.col("k"), F.col("n"), 0.02).alias("p")).collect():
        want = sum(math.exp(math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1) + i * math.log(0.02) + (r.n - i) * math.log(0.98))
                   for i in range(r.k + 1))
        assert r.p == pytest.approx(want, rel=1e-6)
    # 3000 good documents under 100 per mille, 200 bad ones over 500; another stratum with too few
    m = spark.range(3220).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 3200, "en").otherwise("xx").alias("lang"),
        F.when(F.col("id") < 3000, F.col("id") % 100).otherwise(600).cast("int").alias("m_symbols"),
        *(F.lit(0).alias(x) for x in quality.MEASURES[1:]), F.lit(False).alias("base_failed"))
    labels = m.select("doc_id", (F.col("doc_id") < 3000).cast("int").alias("quality"))
    cuts = quality.cutoffs(m, labels).collect()
    assert [(r["_s"], r["cut_m_symbols"], r["cut_m_marks"]) for r in sorted(cuts)] == [("en", 600, None), ("xx", None, None)]
    assert sum(r["n_good"] for r in cuts) == pytest.approx(3000 * 3 / 4, rel=0.1)


def test_cutoffs_are_tested_jointly(spark):
    """Two measures that each lose 2 % of the good documents, others than each
    other: either may be used at a risk of 3 %, not both. A stratum of some 200
    good labels gets its rule; documents that the base rules reject don't count."""
    m = spark.range(12000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") >= 11000, "small").otherwise("en").alias("lang"),
        F.when((F.col("id") % 50 == 0) | (F.col("id") % 10 == 9), 300).otherwise(0).cast("int").alias("m_symbols"),
        F.when((F.col("id") % 50 == 1) | (F.col("id") % 10 == 8), 300).otherwise(0).cast("int").alias("m_capitals"),
        *(F.lit(0).alias(x) for x in quality.MEASURES[2:]), F.col("id").between(11300, 11999).alias("base_failed"))
    m = m.withColumn("m_symbols", F.when((F.col("lang") == "small") & (F.col("doc_id") % 50 == 0), 0).otherwise(F.col("m_symbols")))
    m = m.withColumn("m_capitals", F.when(F.col("lang") == "small", 0).otherwise(F.col("m_capitals")))
    labels = m.select("doc_id", (F.col("doc_id") % 10 < 8).cast("int").alias("quality"))
    cuts = {r["_s"]: r for r in quality.cutoffs(m, labels).collect()}
    used = [x for x in quality.MEASURES if cuts["en"][f"cut_{x}"] is not None]
    assert used in (["m_symbols"], ["m_capitals"])
    assert cuts["small"]["n_good"] < 240 and cuts["small"]["cut_m_symbols"] == 300


def test_stages_pass_columns_of_any_name(spark):
    """Columns with the names that the operators use inside come back as they were."""
    names = ["_text", "_words", "_lines", "_s", "row", "n_words", "m_symbols", "cut_m_marks", "kept", "gone", "_gone", "_toxicity", "score", "good", "bad"]
    long = "the quick brown fox jumps over the lazy dog and runs far away " * 3
    df = spark.createDataFrame([(i, f"{long} {i} " + " ".join(f"w{i}{j}" for j in range(60)), "en", "s", 0, *[f"{n}{i}" for n in names]) for i in range(6)],
                               "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(4)], "doc_id long, quality int, toxic int")
    for out in (quality.keep(df, labels), toxicity.keep(df, labels), neardup.keep(df)):
        assert out.columns == df.columns
        rows = out.collect()
        assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)


def brute_components(rows, width):
    sets = {}
    for d, t in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(t)]
        sets[d] = {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    label = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                i = len(sets[a] & sets[b])
                if i and 100 * i >= 80 * (len(sets[a]) + len(sets[b]) - i):
                    label[a] = min(label[a], label[b])
    return {d: (len(sets[d]), label[d]) for d in sets}


def test_near_duplicates(spark, none):
    base = [f"w{i}" for i in range(200)]
    rows = [(0, None), (1, ""), (2, "one two"), (3, "One TWO"), (4, LONG), (5, LONG + " tail")]
    for k in range(40):  # copies of one text that are less alike among themselves
        w = list(base)
        w[5 * (k % 40)] = f"x{k}"
        rows.append((100 + k, " ".join(w)))
    rows += [(300 + k, " ".join(f"v{k}_{i}" for i in range(30))) for k in range(10)] + [(400, " ".join(base))]
    docs = spark.createDataFrame([(*r, 1) for r in rows] + [(100, rows[6][1], 1), (None, "one two", 1)], "doc_id long, text string, component_id int")
    want = brute_components(rows, 4)
    for r in neardup.near_duplicates(docs, width=4).collect():
        if r.doc_id is None:
            assert r.kept and r.component_id is None
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id)
    kept = [r.doc_id for r in neardup.keep(docs, width=4).collect()]
    assert neardup.keep(docs).columns == docs.columns and 100 in kept and 400 not in kept and None in kept
    assert neardup.near_duplicates(none).count() == 0


def test_block_comparison_finds_what_centres_miss(spark, monkeypatch):
    # no centre: every pair is left to the blocks
    monkeypatch.setattr(neardup, "BLOCK", 3)
    monkeypatch.setattr(neardup, "_centred", lambda m: m.groupBy("bucket").agg(F.max("n").alias("n"), F.lit(-1).cast("long").alias("centre")))
    rows = [(k, " ".join(f"w{i}" for i in range(k, k + 60))) for k in range(12)]
    want = brute_components(rows, 4)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_near_duplicates_move_only_texts_they_compare(spark, monkeypatch):
    # documents that share half their words meet in bands, but link with nothing
    rows = [(2 * k + j, " ".join([f"s{k}_{i}" for i in range(60)] + [f"o{k}_{j}_{i}" for i in range(25)])) for k in range(20) for j in (0, 1)]
    rows += [(100, " ".join(f"n{i}" for i in range(90))), (101, " ".join(f"n{i}" for i in range(91)))]
    moved, settled = [], neardup.settled

    def watched(df, name):
        out = settled(df, name)
        if name == "texts":
            moved.append(out.count())
        return out

    monkeypatch.setattr(neardup, "settled", watched)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, 4)
    assert sum(moved) < 10


def test_sifted_loses_no_id(spark):
    df = spark.createDataFrame([(k, "p", "b") for k in range(-500, 500)] + [(None, "p", "b")], "doc_id long, part string, bits string")
    ids = spark.range(0, 40).select((F.col("id") * 7 - 140).alias("id"))
    bitmap = neardup._bitmap(ids)
    inside = [r.doc_id for r in neardup.sifted(df, F.col("doc_id"), bitmap).collect()]
    outside = [r.doc_id for r in neardup.sifted(df, F.col("doc_id"), bitmap, "left_anti").collect()]
    assert {r.id for r in ids.collect()} <= set(inside) and len(inside) < 80
    assert Counter(inside + outside) == Counter(r.doc_id for r in df.collect())


def test_toxicity(spark, none):
    assert toxicity.folded("L0SER, мoron! 12 5tup1d") == " ioser moron stupid "
    assert toxicity.folded(None) == " "
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for d in range(600):
        w = [f"w{chr(97 + x % 26)}{chr(97 + x // 26)}" for x in rng.integers(0, 400, 60)]
        if toxic := d % 5 == 0:
            w[int(rng.integers(0, 60))] = ("grumbler", "grуmbler", "9rumbler", "Grumbler!")[d % 4]
        rows.append((d, " ".join(w), "x"))
        labels.append((d, int(toxic)))
    docs = spark.createDataFrame([*rows, (None, None, "x"), (1000, "", "x")], "doc_id long, text string, _toxicity string")
    model = toxicity.train(docs, spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, toxic int"))
    got = {r.doc_id: r[toxicity.SCORE] for r in toxicity.scored(docs, model).collect()}
    assert all((got[d] >= 0.5) == bool(t) for d, t in labels) and got[None] < 0.5 and got[1000] < 0.5
    safe = toxicity.Matcher({" grumbler ": 3.0}, [" old grumbler "])
    assert len(safe.hits(" an old grumbler ")) == 0 and len(safe.hits(" a grumbler ")) == 1
    empty = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r[toxicity.SCORE] for r in toxicity.scored(docs, empty).collect()} == {0.0}
    assert toxicity.scored(none, model).count() == 0


def test_language_model(docs, none, monkeypatch):
    monkeypatch.setattr(language_model, "STEPS", 2)
    held = language_model.held_out_sevenths()
    got = language_model.scored(docs, held).collect()
    toks = [(d, [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(t)] + [" end"]) for d, t in TEXTS]
    out = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    c = Counter(w for d, ws in toks if not out(d) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), out(d), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 4)) for d, ws in toks)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score <= 0 for r in got)
    assert language_model.scored(none, held).count() == 0


def test_search(docs, none, monkeypatch):
    monkeypatch.setattr(search, "SHARD_TOKENS", 6000)
    got = search.search(docs, F.col("doc_id") % 2 == 0, 3).collect()
    bag = [(d, Counter(x.encode().lower() for x in words(t))) for d, t in TEXTS]
    mean = sum(sum(b.values()) for _, b in bag) / len(bag)
    df = Counter(w for _, b in bag for w in b)
    for q in {d for d, b in bag if d is not None and d % 2 == 0 and b}:
        query, scores = next(b for d, b in bag if d == q), []
        for d, b in bag:
            if d is None or not set(b) & set(query):
                continue
            n = sum(b.values())
            s = sum(math.log(1 + (len(bag) - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * n / mean)) for w in query if w in b)
            scores.append((-round(s, 6), d))
        assert [(-round(r.score, 6), r.doc_id) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == sorted(scores)[:3]
    assert search.search(none, F.lit(True)).count() == 0


def test_search_by_blocks_and_shards_is_the_same(spark, monkeypatch):
    # small blocks and shards, and ties: the same rows as in one piece; queries and documents are not dealt out
    rows = [(k, " ".join(f"w{(k * i) % 23}" for i in range(1, 12 + k % 5))) for k in range(60)] + [(7, "w1 w2 w3"), (None, "w1 w2"), (61, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    whole = sorted(map(tuple, search.search(docs, F.col("doc_id") % 4 == 0, 5).collect()))
    assert 60 < len(whole) <= 15 * 5
    monkeypatch.setattr(search, "SHARD_TOKENS", 40)
    monkeypatch.setattr(search, "QUERY_BLOCK", 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        plans, settled = [], search.settled
        monkeypatch.setattr(search, "settled", lambda df, name: plans.append((name, df._jdf.queryExecution().optimizedPlan().toString())) or settled(df, name))
        assert sorted(map(tuple, search.search(docs, F.col("doc_id") % 4 == 0, 5).collect())) == whole
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    found = [p for name, p in plans if name == "found"]
    assert len(found) == 4 and all("Generate" not in p and "CoGroup" not in p for p in found)


def test_quotes(spark):
    rows = [(1, 0, "u", "Hello there\nHow are you?"), (1, 1, "a", "On Monday u wrote:\n> how   are you?\nFine."),
            (1, 2, "u", "> > How are you?\n> Fine.\nGood"), (1, 3, "x", "nothing"), (1, 4, "y", "> unmatched\nz"), (2, 0, "u", None), (None, 0, "u", "> a")]
    m = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int")
    got = {(r.conv_id, r.turn): (r.text, r.parent_turn, r.root_turn, r.depth, r.n_quoted) for r in quotes.ordered(quotes.linked(m)).collect()}
    assert got == {(1, 0): ("Hello there\nHow are you?", None, 0, 0, 0), (1, 1): ("Fine.", 0, 0, 1, 1), (1, 2): ("Good", 1, 0, 2, 2),
                   (1, 3): ("nothing", None, 3, 0, 0), (1, 4): ("z", None, 4, 0, 1), (2, 0): ("", None, 0, 0, 0), (None, 0): ("", None, 0, 0, 1)}
    assert quotes.linked(m.where("false")).count() == 0


def test_quotes_of_wrapped_paragraphs(spark):
    first = "One two three four\nfive six.\n\nSeven eight nine\nten.\n\nEleven twelve."
    rows = [(1, 0, "u", first), (1, 1, "a", "No quote here."),
            (1, 2, "u", "> One two\n> three four five six.\n>\n> Eleven\n> twelve.\nYes"), (1, 3, "a", "> Seven\n> eight nine ten.\n>\n> not said\nNo")]
    got = {r.turn: (r.parent_turn, r.root_turn, r.depth) for r in quotes.linked(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {0: (None, 0, 0), 1: (None, 1, 0), 2: (0, 0, 1), 3: (0, 0, 1)}


def test_licenses(spark, none):
    text = "some ordinary words here\nReleased under the MIT License.\nAll rights reserved.\nthe public library reserved a table"
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, "Licensed under CC BY-NC 4.0.")]
    found = licenses.scan(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, family string"))
    got = Counter((r.doc_id, r.paragraph, r.family) for r in found.collect() if r.confirmed)
    assert got == Counter({(1, 1, "MIT"): 2, (1, 2, "all-rights-reserved"): 2, (None, 0, "CC-BY-NC"): 1})
    assert licenses.scan(none).count() == 0


def test_licenses_short_names_and_wrapped_notices(spark):
    wrapped = licenses.TEMPLATES["BSD"][0].replace(", ", ",\n# ").replace("provided", "provided\n#")
    rows = [(1, "Code is CC-BY-4.0."), (2, "SPDX-License-Identifier: Apache-2.0"), (3, "GPLv3 or later"), (4, "MIT-licensed"),
            (5, "Distributed under EUPL 1.2"), (6, f"some words here\n\n# {wrapped}\n\nmore words"), (7, "This programme has a BSD licence")]
    rows += [(100 + k, " ".join(f"v{(k * i) % 97}" for i in range(1, 30))) for k in range(200)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {(r.doc_id, r.paragraph, r.lines): (r.family, r.confirmed) for r in found}
    assert [got[d, 0, 1] for d in (1, 2, 3, 4)] == [("CC-BY", True), ("Apache-2.0", True), ("GPL-3.0", True), ("MIT", True)]
    assert got[5, 0, 1] == (licenses.UNKNOWN, False) and got[6, 2, wrapped.count("\n") + 1] == ("BSD", True)
    assert (7, 0, 1) in got and not [k for k in got if k[0] >= 100]


def test_pipeline_small(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, sf)
    assert kept.columns == docs.columns
    fine = {d for d, t in ((r.doc_id, r.text) for r in docs.collect()) if len(words(t)) >= 50}
    ids = {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()}
    assert ids and ids <= fine
    assert hashlib.sha256(str(sorted(ids)).encode()).hexdigest() == hashlib.sha256(str(sorted(
        {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()})).encode()).hexdigest()


def test_licenses_kept_apart(spark):
    """Share alike, no derivatives, lesser, affero and version 2 are families of
    their own; a denial is not confirmed; short foreign notices are found."""
    rows = [(1, "Licensed under CC BY-SA 4.0."), (2, "Licensed under CC BY-ND 4.0."), (3, "Licensed under the GNU General Public License, version 2."),
            (4, "This work is licensed under the GNU Affero General Public License, version 3."), (5, "Not licensed under the MIT License."),
            (6, "MIT-Lizenz"), (7, "Tous droits réservés."), (8, "Licensed under CC BY 4.0."), (9, "Licensed under the MIT License."),
            (10, "Distributed under MPL 2.0")]
    prose = [(100 + i, " ".join(f"word{(i * 7 + j) % 90}" for j in range(12)) + ".\nThe terms of this and that, free to all of us.") for i in range(60)]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows + prose, "doc_id long, text string")).collect()}
    assert not any(d >= 100 for d in found)
    families = {d: found[d].family for d in (1, 2, 3, 4, 6, 7, 8, 9, 10)}
    confirmed = {d: found[d].confirmed for d in (1, 2, 3, 4, 8, 9)}
    assert families == {1: "CC-BY-SA", 2: "CC-BY-ND", 3: "GPL-2.0", 4: "AGPL-3.0", 6: "MIT", 7: "all-rights-reserved", 8: "CC-BY", 9: "MIT", 10: "MPL-2.0"}
    assert all(confirmed.values()) and not found[5].confirmed


def test_licence_words_skip_exactly(spark):
    """Paragraphs without a needed word are those that score as none anyway."""
    text = "\n".join(["Released under the MIT License.", "plain line of words", "", "Apache", "of the and", "Some rights of the author", "word " * 30, "GPL"])
    docs = spark.createDataFrame([(i, text.replace("plain", f"plain{i}")) for i in range(40)], "doc_id long, text string")
    counter, model, names, _ = licenses.train(docs)
    needed = licenses.needed_words(counter, model, len(names) - 1)
    assert needed
    every = licenses.probabilities(licenses.paragraph_words(docs), counter, model).collect()
    likely = {(r.doc_id, r.paragraph, r.lines) for r in every if r.p[-1] <= 0.5}
    some = {(r.doc_id, r.paragraph, r.lines) for r in licenses.paragraph_words(docs, needed).collect()}
    assert likely and likely <= some and len(some) < len(every)
    a = {(r.doc_id, r.paragraph, r.lines): r.words for r in licenses.paragraph_words(docs).collect()}
    b = licenses.paragraphs(docs).select("doc_id", "paragraph", "lines", licenses.words("text").alias("words")).where("size(words) > 0").collect()
    assert a == {(r.doc_id, r.paragraph, r.lines): r.words for r in b}


def test_model_features_of_many_texts_are_those_of_each():
    texts = ["a b c d", "", None, "x", "x y", "A b  c", "one two three"]
    alone = [language_model._tokens(t) for t in texts]
    keys, c = np.unique(np.concatenate(alone), return_counts=True)
    vocab = language_model.Vocabulary(keys[::2], np.arange(len(keys[::2])) % language_model.CLASSES, c[::2], int(c.sum()), len(keys))
    frame = pd.DataFrame({"doc_id": range(len(texts)), "keys": [k.tobytes() for k in alone]})
    (rows_, all_, begins), = language_model._parts(iter([frame]))
    assert rows_["doc_id"].tolist() == list(range(len(texts))) and begins.tolist() == np.cumsum([0, *map(len, alone[:-1])]).tolist()
    together = language_model._cells(all_, begins, vocab)
    each = [language_model._cells(k, np.array([0]), vocab) for k in alone]
    for k in range(3):
        assert together[k].tolist() == np.concatenate([x[k] for x in each]).tolist()


def test_ascii_letters_need_no_pattern():
    enc = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    class Never:
        def match(self, chunk):
            raise AssertionError(chunk)
    words = ["hello", "WORLD", "qzxv"]
    plain, enc.plain = enc.plain, Never()
    assert [tokens.as_array(enc.ids(w)).tolist() for w in words] == [enc.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    enc.plain = plain
    for w in ("\xaa\xb5\xba", "\u00e9t\u00e9", "\u0430b", "a1", "\u00df", "x\u0301"):
        assert tokens.as_array(enc.ids(w)).tolist() == enc.tokenizer.encode(w, add_special_tokens=False).ids


def test_search_reads_each_text_once_and_prunes_by_bounds(spark, monkeypatch):
    # several blocks of queries meet an index that is written once; no document is left out for its bounds, copies and ties included
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{w}" for w in (rng.pareto(0.6, 5 + k % 60) * 4).astype(int) % 4000) for k in range(700)]
    rows = [(k, texts[k if k % 9 else 9]) for k in range(700)] + [(None, texts[9]), (1 << 40, texts[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(search, "SHARD_TOKENS", 2500)
    monkeypatch.setattr(search, "QUERY_BLOCK", 20)
    names, settled = [], search.settled
    monkeypatch.setattr(search, "settled", lambda df, name: names.append((name, df._jdf.queryExecution().optimizedPlan().toString())) or settled(df, name))
    got = {}
    for r in search.search(docs, F.col("doc_id") % 7 == 0, 6).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((round(-r.score, 8), r.doc_id))
    assert sum(n == "index" for n, _ in names) == 1 and len([p for n, p in names if n == "found"]) > 4
    assert all("text" not in p for n, p in names if n in ("first", "found"))
    bag = [(d, Counter(t.split())) for d, t in rows]
    df = Counter(w for _, b in bag for w in b)
    mean = sum(sum(b.values()) for _, b in bag) / len(bag)
    idf = {w: math.log(1 + (len(bag) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    parts = [(d, {w: idf[w] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * sum(b.values()) / mean)) for w, n in b.items()}) for d, b in bag if d is not None]
    assert set(got) == {d for d, _ in parts if d % 7 == 0}
    for q, found in got.items():
        query = next(b for d, b in bag if d == q)
        scores = sorted((round(-sum(x for w, x in p.items() if w in query), 8), d) for d, p in parts if query.keys() & p.keys())
        assert found == scores[:6]


def test_words_before_symbols_are_not_met_anew():
    # a word and the symbols after it are chunks of their own, with the library's ids
    text = "then&&& other### Other$$$ thêr*** en%%% then the&&& a&b&& it's& x5&& <|&& the'&&&\n the#|.　&the $the* the*\x85the% é&"
    for path in (WORD, BYTE):
        enc, whole = tokens.Encoder(path), Tokenizer.from_file(path)
        assert tokens.as_array(enc.ids(text)).tolist() == whole.encode(text, add_special_tokens=False).ids
        assert not {c.strip() for c in enc} & {"then&&&", "other###", "Other$$$", "thêr***", "en%%%"}


def test_search_takes_one_shard_at_a_time(spark, monkeypatch):
    # a shard is a file and a batch of its own, whatever a task reads; the session's settings are as before
    key, names, settled = "spark.sql.execution.arrow.maxRecordsPerBatch", [], search.settled
    docs = spark.createDataFrame([(k, f"w{k % 7} w{k % 11} w{k % 3}") for k in range(60)], "doc_id long, text string").coalesce(1)
    whole = sorted(map(tuple, search.search(docs, F.col("doc_id") % 4 == 0, 3).collect()))
    monkeypatch.setattr(search, "SHARD_TOKENS", 10)
    spark.conf.set(key, "4")
    try:
        monkeypatch.setattr(search, "settled", lambda df, name: names.append((name, spark.conf.get(key), out := settled(df, name))) or out)
        assert sorted(map(tuple, search.search(docs, F.col("doc_id") % 4 == 0, 3).collect())) == whole
        assert spark.conf.get(key) == "4" and spark.conf.get("spark.sql.files.maxRecordsPerFile") == "0"
    finally:
        spark.conf.set(key, "256")
    index, = (out for name, _, out in names if name == "index")
    assert index.count() == len(index.inputFiles()) == 15
    assert {batch for name, batch, _ in names if name in ("frequencies", "first", "found")} == {"1"}


def test_model_tells_words_outside_the_head_by_both_words_before(spark, monkeypatch):
    # without a head every word is in a group: its probability follows the word before, and the one before that
    monkeypatch.setattr(language_model, "vocabulary", lambda counts, own=language_model.vocabulary: own(counts, 0))
    rng = np.random.default_rng(3)
    rows, of = [], {}
    for k in range(400):
        a, b = rng.integers(0, 2, 2).tolist()
        if k % 2:  # the last word by the word before, or by the one before that
            rows.append((k, f"near{a} {'xy'[a]}"))
        else:
            rows.append((k, f"far{b} m {'vw'[b]}"))
        of[k] = a if k % 2 else b
    swapped = [(1000 + k, t.translate(str.maketrans("xyvw", "yxwv"))) for k, t in rows[:60]]
    docs = spark.createDataFrame(rows + swapped, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in language_model.scored(docs, F.col("doc_id") >= 1000).collect()}
    assert all(got[1000 + k].held_out and got[1000 + k].n_known == got[1000 + k].n_tokens for k in range(60))
    assert all(got[k].score > got[1000 + k].score + 0.2 for k in range(60))
    # the base model has no context: there the two differ by the words' counts alone
    assert max(abs(got[k].base_score - got[1000 + k].base_score) for k in range(60)) < 0.2


def test_probabilities_of_a_group_sum_to_one():
    rng = np.random.default_rng(0)
    for v, n in ((1, 5), (2, 50), (3, 50), (37, 3000), (1025, 90000)):
        words = np.sort(np.concatenate([np.arange(v), np.arange(v), rng.integers(0, v, n)]))
        asked = np.append(True, np.diff(words) > 0)  # each word once, after the same two, not learned from
        before, skip = (np.where(asked, 7, rng.integers(0, 50, len(words))).astype("<u4") for _ in range(2))
        logs = language_model._choices(words, np.bincount(words, ~asked, v), before, skip, ~asked)
        assert abs(np.exp(logs[asked]).sum() - 1) < 1e-9


def test_both_words_before_reach_the_members_of_the_head():
    keys = np.concatenate([language_model._tokens(f"{a} {b} word") for a in "abcdefgh" for b in "ijklmnop"])
    vocab = language_model.Vocabulary(*(lambda k, c: (k, np.zeros(len(k), np.int64), c, int(c.sum()), len(k)))(*np.unique(keys, return_counts=True)))
    cells = language_model._cells(keys, np.arange(0, len(keys), 4), vocab)[2].reshape(-1, 4)[:, 2]
    by_near = {}
    for k, cell in enumerate(cells.tolist()):
        by_near.setdefault(k % 8, set()).add(cell)
    assert all(len(found) > 1 for found in by_near.values())
