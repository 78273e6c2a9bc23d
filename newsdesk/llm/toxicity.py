"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lowers the text, replaces look-alike letters of other alphabets and
width forms by Latin ones, reads digits and signs next to letters as the
letters they stand for (l and 1 both as i), and drops invisible characters;
what is no letter then separates words.

The lexicon is learnt from labelled rows: whole words and word beginnings of 4
to 7 letters, weighted by their log odds between toxic and clean documents and
kept where a likelihood ratio beats chance over all candidates; of entries that
begin alike the one with the most evidence stays. The ratio is asked for twice,
over documents and then over distinct contexts (the words on both sides), so
that words of a text with many copies are no evidence. Exception phrases are an
entry with the word before or after it that clean documents have in at least
nine cases of ten; an entry inside one does not count. A document's score is a
logistic function of its mass of weights and of that mass by its length.

Fitting reads at most ``TRAIN_ROWS`` labelled rows (those with the smallest
hash of the id); every document is scored, over its whole text.

Defined results: null and empty texts match nothing and get the score of that;
labels without a doc_id or toxic value, or that contradict each other, are not
used; without usable labels of both kinds every score is 0; repeated rows get a
row each; no rows give no rows. All columns pass through.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from newsdesk.llm.common import fold_of, settled, unused

TRAIN_ROWS = 20_000
MAX_ENTRIES = 5_000
SCORE = "_toxicity"

# Letters that look like Latin ones (Cyrillic, Greek, Latin),
# and what digits and signs are read as.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "ѕ": "s", "і": "i", "ї": "i", "ј": "j", "һ": "h", "ӏ": "l", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g",
}
SUBSTITUTES = dict(zip("0134578@$9", "oieastbasg"))
INVISIBLE = "­​‌‍⁠﻿"

_FOREIGN = re.compile("[" + re.escape("".join(LOOK_ALIKES)) + INVISIBLE + "]")
_TABLE = str.maketrans(LOOK_ALIKES) | dict.fromkeys(map(ord, INVISIBLE))
_SIGNS = re.compile(r"[0134578@$9]+(?=[^\W\d_])|(?<=[^\W\d_])(?:[0134578@$9]+|!(?=[^\W\d_]))")
_SIGN_TABLE = str.maketrans(SUBSTITUTES | {"!": "i"})
_GAPS = re.compile(r"[\W\d_]+")


def folded(text: str | None) -> str:
    """Words with a space before, between and after them."""
    if not text:
        return " "
    text = text.lower()
    if not text.isascii():
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text).lower()
        if _FOREIGN.search(text):
            text = text.translate(_TABLE)
    text = _SIGNS.sub(lambda m: m[0].translate(_SIGN_TABLE), text)
    return f" {_GAPS.sub(' ', text).replace('l', 'i').strip()} ".replace("  ", " ")


@dataclass
class Model:
    """weights: of entries (" word " or " beginning"); exceptions: phrases;
    fit: bias and the weights of log mass and log density."""
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    fit: tuple[float, float, float] | None = None


class Matcher:
    def __init__(self, weights: dict[str, float], exceptions: list[str]):
        self.auto = ahocorasick.Automaton()
        for e in exceptions:
            self.auto.add_word(e, (len(e), None))
        for w, x in weights.items():
            self.auto.add_word(w, (len(w), x))
        if len(self.auto):
            self.auto.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, float]]:
        """Begin, end and weight of the entries outside exceptions."""
        if not len(self.auto):
            return []
        found = [(at - n + 1, at + 1, w) for at, (n, w) in self.auto.iter(text)]
        safe = [(a, b) for a, b, w in found if w is None]
        return [(a, b, w) for a, b, w in found if w is not None and not any(x <= a and b <= y for x, y in safe)]


def _features(matcher: Matcher, text: str) -> tuple[float, float]:
    mass = sum(max(w, 0.0) for _, _, w in matcher.hits(text))
    return math.log1p(mass), math.log1p(100 * mass / (text.count(" ") + 9))


def _entries(text: str) -> set[str]:
    words = set(text.split())
    return {f" {w} " for w in words if len(w) > 2} | {f" {w[:n]}" for w in words for n in range(4, min(8, len(w)))}


def _word(text: str, a: int) -> tuple[int, int, int, int]:
    """Of the word that begins at the space ``a``: begin of the word before,
    its own begin and end, end of the word after."""
    end = text.index(" ", a + 1) + 1
    return max(0, text.rfind(" ", 0, a)), a, end, (text.find(" ", end) + 1) or end


def _contexts(matcher: Matcher, text: str) -> set[tuple[str, int]]:
    """Entries with a hash of the words on both sides."""
    out = set()
    for a, b, _ in matcher.hits(text):
        p, begin, end, q = _word(text, a)
        out.add((text[a:b], zlib.crc32(f"{text[p:begin]}|{text[end:q]}".encode())))
    return out


def _phrases(matcher: Matcher, text: str) -> set[tuple[str, int]]:
    """Words with an entry and the word before or after; hashes of the rest."""
    out = set()
    for a, _, _ in matcher.hits(text):
        p, begin, end, q = _word(text, a)
        if p < begin:
            out.add((text[p:end], zlib.crc32(text[end:q].encode())))
        if q > end:
            out.add((text[begin:q], zlib.crc32(text[p:begin].encode())))
    return out


def _counted(train: DataFrame, of, contexts: bool = False) -> DataFrame:
    """entry, toxic, clean: the training documents of each kind that have it,
    or the distinct contexts they have it in."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Counter(), Counter()
        for b in batches:
            for text, toxic in zip(b["text"].tolist(), b["toxic"].tolist()):
                seen[toxic].update(of(folded(text)))
        keys = list(seen[0] | seen[1])
        if not keys:
            return
        yield pd.DataFrame({"entry": [k[0] if contexts else k for k in keys], "context": [k[1] if contexts else 0 for k in keys],
                            "toxic": [seen[1][k] for k in keys], "clean": [seen[0][k] for k in keys]})

    rows = (train.select("text", F.col("toxic").cast("int").alias("toxic"))
            .mapInPandas(run, "entry string, context long, toxic long, clean long"))
    if contexts:
        rows = rows.groupBy("entry", "context").agg(*(F.max(F.least(c, F.lit(1))).alias(c) for c in ("toxic", "clean")))
    return rows.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _evident(counted: DataFrame, share: float, tries: int) -> list:
    """The entries that the toxic side has more often than chance allows."""
    t, c = F.col("toxic"), F.col("clean")
    gain = t * F.log(t / (t + c) / share) + F.when(c > 0, c * F.log(c / (t + c) / (1 - share))).otherwise(0.0)
    return (counted.where((t > 0) & (t / (t + c) > share)).withColumn("gain", gain)
            .where(F.col("gain") >= math.log(max(tries, 1)) + 3).orderBy(F.desc("gain"), F.desc(F.length("entry")), "entry")
            .limit(MAX_ENTRIES).collect())


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """text, toxic (boolean) of at most ``limit`` labelled documents whose id's
    crc32 modulo 5 is not 0."""
    sure = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold_of(F.col("doc_id"), 5) != 0))
            .groupBy("doc_id").agg(F.min("toxic").alias("_low"), F.max("toxic").alias("_high")).where("_low = _high")
            .select("doc_id", (F.col("_low") > 0).alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sure), "doc_id").select("text", "toxic")


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> Model:
    rows = settled(training_rows(docs, labels, limit), "toxic-train")
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    bad, good = n.get(True, 0), n.get(False, 0)
    if not bad or not good:
        return Model()
    counted = settled(_counted(rows, _entries), "toxic-entries")
    share, tries = bad / (bad + good), counted.count()
    odds = {r["entry"]: math.log((r["toxic"] + 0.5) / (bad + 1) / ((r["clean"] + 0.5) / (good + 1)))
            for r in _evident(counted, share, tries)}
    matcher = _matcher_of(odds, [])
    weights: dict[str, float] = {}
    for r in _evident(_counted(rows, lambda x: _contexts(matcher(), x), True), share, tries):
        e = r["entry"].rstrip()
        if not any(k.rstrip().startswith(e) or e.startswith(k.rstrip()) for k in weights):
            weights[r["entry"]] = odds[r["entry"]]
    chosen = _matcher_of(weights, [])
    safe = [r["entry"] for r in _counted(rows, lambda x: _phrases(chosen(), x), True)
            .where("clean >= 3 and clean >= 9 * toxic").orderBy(F.desc("clean"), "entry").limit(MAX_ENTRIES).collect()]
    return Model(weights, safe, _fit(rows, weights, safe))


def _matcher_of(weights: dict[str, float], exceptions: list[str]):
    """Builds the matcher once in each worker."""
    key = tuple(weights.items()), tuple(exceptions)
    return lambda: _cached(key)


@lru_cache(maxsize=4)
def _cached(key) -> Matcher:
    return Matcher(dict(key[0]), list(key[1]))


def _fit(rows: DataFrame, weights: dict[str, float], safe: list[str]) -> tuple[float, float, float]:
    """Logistic regression on the features rounded to sixteenths (at most 128
    by 128 bins come to the driver), by Newton steps with a small penalty."""
    matcher = _matcher_of(weights, safe)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Counter()
        for b in batches:
            for text, toxic in zip(b["text"].tolist(), b["toxic"].tolist()):
                x, y = _features(matcher(), folded(text))
                seen[min(127, round(16 * x)), min(127, round(16 * y)), bool(toxic)] += 1
        if seen:
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["x", "y", "toxic", "n"])

    bins = rows.mapInPandas(run, "x int, y int, toxic boolean, n long").groupBy("x", "y", "toxic").agg(F.sum("n").alias("n")).collect()
    a = np.array([(1, r["x"] / 16, r["y"] / 16) for r in bins])
    y, n = np.array([float(r["toxic"]) for r in bins]), np.array([float(r["n"]) for r in bins])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (n * (p - y)) + 0.1 * w
        step = np.linalg.solve((a * (n * p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(3), grad)
        w -= step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(x) for x in w)


def scored(docs: DataFrame, model: Model, name: str = SCORE) -> DataFrame:
    """The rows with the score, 0 to 1, as column ``name``."""
    docs = docs.drop(name)
    at = [c.lower() for c in docs.columns].index("text")
    matcher, fit = _matcher_of(model.weights, model.exceptions), model.fit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = []
            for text in b.column(at).cast(pa.string()).to_pylist():
                if fit is None:
                    scores.append(0.0)
                    continue
                x, y = _features(matcher(), folded(text))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, fit[0] + fit[1] * x + fit[2] * y)))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], names=[*b.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose score is under one half, with the columns of ``docs``."""
    name = unused(docs, SCORE)
    return scored(docs, train(docs, labels), name).where(F.col(name) < 0.5).drop(name)
