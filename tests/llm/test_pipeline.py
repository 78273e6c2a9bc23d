"""The four stages on planted documents, each held against plain Python on what
the stage before kept."""

import random
import re
import uuid
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from newsdesk.session import checkpoint_dir

SLURS = ["zorgblat", "grumfniz"]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted():
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice("abcdefghijklmnopqrstuvw") + str(rng.randint(0, 900)) for _ in range(n))
    docs, labels = [], []

    def add(text, toxic=None, quality=None):
        docs.append((len(docs), text, rng.choice(["en", "de", None]), "s", len(text or "")))
        if toxic is not None or quality is not None:
            labels.append((len(docs) - 1, quality, toxic))

    for _ in range(120):
        add(prose(rng.randint(60, 200)), 0, 1)
    for k in range(60):
        add(f"{prose(60)} {SLURS[k % 2]} you {SLURS[k % 2]} {prose(20)}", 1 if k < 40 else None, 1)
    for t in ("", None, prose(20), "same words here " * 40, "  \n\t "):
        add(t)
    for k in range(20):                                    # copies, near copies, and documents that share a half
        text = docs[k][1]
        add(text)
        w = text.split()
        add(" ".join(["changed", *w[1:]]))
        add(" ".join([*w[:len(w) // 2], prose(len(w))]))
    rng.shuffle(docs)
    return docs, labels


def base_kept(text):
    w = words(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    covered = {j for i, x in enumerate(windows) if n[x] > 1 for j in (i, i + 1, i + 2)}
    return len(w) >= 50 and 100 * len(covered) <= 50 * len(w)


def near_kept(texts):
    """The smallest id of each component at five words and 0.8."""
    sets = {}
    for d, t in texts.items():
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(t)]
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    label = {d: d for d in sets}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return {d for d in sets if label[d] == d}


def test_stages_against_plain_python(spark):
    docs, labels = planted()
    sf = checkpoint_dir(spark, "tests", uuid.uuid4().hex)
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    frame.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    left, out = {d[0]: d[1] for d in docs}, spark.read.parquet(f"{sf}/documents.parquet")
    want = [
        lambda t: {d for d, x in t.items() if base_kept(x)},                # good labels alone: no cutoff has anything to catch
        lambda t: {d for d, x in t.items() if not any(s in x for s in SLURS)},
        near_kept]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:3]):
        kept = stage(spark, out, sf)
        assert kept.columns == frame.columns
        kept.write.parquet(f"{sf}/{k}")
        out = spark.read.parquet(f"{sf}/{k}")
        ids = want[k](left)
        assert {r.doc_id for r in out.collect()} == ids, name
        assert 0 < len(ids) < len(left) and out.count() == len(ids)
        left = {d: left[d] for d in ids}
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = set()
    for d, x in left.items():
        ids = t.encode(x, add_special_tokens=False).ids + [0]
        pieces |= {(d, k, at, len(ids[at:at + 2048]), zlib.crc32(np.array(ids[at:at + 2048], "<u4").tobytes()))
                   for k, at in enumerate(range(0, len(ids), 2048))}
    packed = corpus_pipeline.run(spark, sf).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed} == pieces and len(packed) == len(pieces)
