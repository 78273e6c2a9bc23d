"""Phrase collocations by dynamic itemset counting.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those
into words ``[^\\x20\\x09]+``; phrases are 1 to ``LONGEST`` words in a row of one
piece. Everything is per language.

The documents are dealt to ``SHARDS`` shards of word numbers, which are scanned
in turn, round and round. A scan counts phrases of all lengths at once. Words are counted from
the start; a longer phrase is activated as soon as the phrases without its last
and without its first word have both reached ``threshold`` in what was counted
so far, is counted from the next scan on, and is complete after one full cycle,
with an exact count, as each shard was scanned once. The scans end when none is
active.

What tasks know of the phrases that reached the threshold is a bit for each, in
a bitmap of a fixed 2**``BITS`` bits for each of the last scans (the only thing
that goes through the driver: at most 2**``BITS`` / 64 numbers a scan). A phrase
is counted in scan t if the bits of both parts are set in the bitmap of t and
not in that of t - ``SHARDS`` (then its cycle is over). Bits that are set by
another phrase's hash only have more phrases counted: for a phrase the
bitmaps say the same in every task and scan, so each has exactly one cycle.
Counts are summed in the task (``TOKENS`` words at a time; there, hashes of 64
bits that agree are taken as one phrase) before they are shuffled by text; the counters of a scan are a written table, and a phrase that
completes its cycle below the threshold leaves it.

Defined results: a null text is empty, a null language ``und``; ids aren't read,
so rows that repeat count as often as they occur; no rows give no rows. Columns
other than text and lang are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from newsdesk.llm.common import settled
from newsdesk.llm.neardup import _mixed
from newsdesk.session import ensure_checkpoint_dir

LONGEST, THRESHOLD, TOP = 4, 30, 2000
SHARDS, BITS = 2, 26
TOKENS = 3_000_000
_NEVER = 2 ** 15 - 1
_SEED = np.uint64(0x9E3779B97F4A7C15)
_ENDS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b".........")


def _word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "replace") + b"\t" + word)


def _joined(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of all but its last word, and that word's."""
    return _mixed((h ^ word) * _SEED)


class _Words(dict):
    """Numbers from 1 for the words of one language; 0 ends a piece."""

    def __init__(self, lang: int, known: list[tuple[int, bytes]]):
        super().__init__({b".": 0})
        self.lang, self.known = lang, known

    def __missing__(self, word: bytes) -> int:
        self.known.append((self.lang, word))
        self[word] = len(self.known)
        return len(self.known)


class _Chunk:
    """Word numbers of some documents, and what the numbers stand for."""

    def __init__(self) -> None:
        self.ids: list[np.ndarray] = []
        self.size, self.langs, self.words, self.known = 0, [], {}, []

    def add(self, lang: str, texts: list[bytes]) -> None:
        if lang not in self.words:
            self.words[lang] = _Words(len(self.langs), self.known)
            self.langs.append(lang)
        tokens = (b".".join(texts) + b".").lower().translate(_ENDS).replace(b".", b" . ").split()
        self.ids.append(np.fromiter(map(self.words[lang].__getitem__, tokens), np.int32, len(tokens)))
        self.size += len(tokens)

    def row(self, shard: int) -> pa.RecordBatch:
        hashes = np.fromiter((_word_hash(self.langs[k], w) for k, w in self.known), np.uint64, len(self.known))
        of = np.fromiter((k for k, _ in self.known), np.int32, len(self.known))
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([np.concatenate(self.ids).tobytes()], pa.binary()), pa.array([hashes.tobytes()], pa.binary()),
             pa.array([of.tobytes()], pa.binary()), pa.array([b" ".join(w for _, w in self.known)], pa.binary()),
             pa.array([self.langs], pa.list_(pa.string()))], ["shard", "ids", "hashes", "lang_of", "words", "langs"])


CHUNKS = "shard int, ids binary, hashes binary, lang_of binary, words binary, langs array<string>"


def _chunks(shards: int):
    """The documents as chunks of some ``TOKENS`` word numbers for each shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [_Chunk() for _ in range(shards)]
        for b in batches:
            by: dict[tuple, list[bytes]] = {}
            for shard, lang, text in zip(b.column("shard").to_pylist(), b.column("lang").to_pylist(), b.column("text").to_pylist()):
                by.setdefault((shard, lang), []).append(text.encode("utf-8", "replace"))
            for (shard, lang), texts in by.items():
                held[shard].add(lang, texts)
                if held[shard].size >= TOKENS:
                    yield held[shard].row(shard)
                    held[shard] = _Chunk()
        for shard, c in enumerate(held):
            if c.size:
                yield c.row(shard)
    return run


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of one of each value, and how often it occurs."""
    order = np.argsort(h)
    new = np.ones(len(h), bool)
    new[1:] = h[order[1:]] != h[order[:-1]]
    at = np.flatnonzero(new)
    return order[at], np.diff(np.append(at, len(h)))


def _counted(step: int, shards: int, maps: dict):
    """(lang, phrase, n, since) of a shard; since is the scan in which the
    phrase was activated. The phrase '' has the number of words."""
    def since(h: np.ndarray) -> np.ndarray:
        """The scan from which on a phrase's bit is set."""
        place = h >> np.uint64(64 - BITS)
        slot, bit = (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))
        out = np.full(len(h), _NEVER, np.int16)
        for u in sorted(maps, reverse=True):
            out[(maps[u].value[slot] & bit) != 0] = u
        return out

    def counts(ids: np.ndarray, hashes: np.ndarray) -> Iterator[tuple]:
        """(numbers of the words, n, since) for each length."""
        words = np.concatenate([[np.uint64(0)], hashes])
        if step < shards:
            n = np.bincount(ids, minlength=len(words))
            n[0] = 0
            of = np.flatnonzero(n)
            yield of[:, None], n[of], np.zeros(len(of), np.int16)
        h = _joined(np.uint64(0), words)
        first = since(h)
        first[0] = _NEVER
        reached, h = first[ids], h[ids]  # at each place: since when the phrase that begins there, and its hash
        for length in range(2, min(LONGEST, len(ids)) + 1):
            from_ = np.maximum(reached[:-1], reached[1:])  # the part without the last word, and that without the first
            at = np.flatnonzero(from_ <= step)
            from_ = from_[at]
            of = _joined(h[at], words[ids[at + length - 1]])
            now = from_ > step - shards  # else its cycle is over
            one, n = _distinct(of[now])
            places = at[now][one]
            yield ids[places[:, None] + np.arange(length)], n, from_[now][one]
            if length < LONGEST:
                h = np.zeros(len(h) - 1, np.uint64)
                h[at] = of
                reached = np.full(len(reached) - 1, _NEVER, np.int16)
                reached[at] = np.maximum(since(of), from_)  # another phrase may have set the bit earlier

    def rows(chunk: dict) -> Iterator[pa.RecordBatch]:
        lang_of = np.concatenate([[0], np.frombuffer(chunk["lang_of"], np.int32)])
        langs = pa.array(chunk["langs"], pa.string())
        names = pa.array([b"", *chunk["words"].split(b" ")], pa.binary()).cast(pa.string())
        for phrase, n, activated in counts(np.frombuffer(chunk["ids"], np.int32), np.frombuffer(chunk["hashes"], np.uint64)):
            if phrase.shape[1] == 1:
                words = np.bincount(lang_of[phrase[:, 0]], weights=n, minlength=len(langs)).astype(np.int64)
                yield batch(langs, pa.array([""] * len(langs), pa.string()), words, np.zeros(len(langs)))
            for k in range(0, len(n), 100_000):
                of = phrase[k:k + 100_000]
                text = pc.binary_join_element_wise(*(names.take(pa.array(w)) for w in of.T), " ")
                yield batch(langs.take(pa.array(lang_of[of[:, 0]])), text, n[k:k + 100_000], activated[k:k + 100_000])

    def batch(lang: pa.Array, phrase: pa.Array, n, activated) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([lang, phrase, pa.array(n.astype(np.int64)), pa.array(activated.astype(np.int32))],
                                          ["lang", "phrase", "n", "since"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                yield from rows({c: b.column(c)[k].as_py() for c in ("ids", "hashes", "lang_of", "words", "langs")})
    return run


def _bits(bits: int):
    """(slot, bits) of the phrases that reached the threshold."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            words = [p.encode("utf-8").split(b" ") for p in b["phrase"].tolist()]
            h = np.zeros(len(words), np.uint64)
            for k in range(max(map(len, words), default=0)):
                of = np.array([i for i, w in enumerate(words) if len(w) > k])
                langs = b["lang"].tolist()
                h[of] = _joined(h[of], np.array([_word_hash(langs[i], words[i][k]) for i in of.tolist()], np.uint64))
            place = h >> np.uint64(64 - bits)
            yield pd.DataFrame({"slot": (place >> np.uint64(6)).astype(np.int64), "bits": (np.uint64(1) << (place & np.uint64(63))).view(np.int64)})
    return run


def _words_of(phrase: str) -> Column:
    return F.split(F.col(phrase), " ", -1)


def frequent(docs: DataFrame, threshold: int = THRESHOLD, shards: int | None = None) -> DataFrame:
    """(lang, phrase, n): the phrases of up to LONGEST words that occur
    ``threshold`` times or more, with their exact counts, and for each language
    the phrase '' with the number of its words."""
    spark, shards = docs.sparkSession, shards or SHARDS
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/shards-{uuid.uuid4().hex}"
    (docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                 F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"))
     .mapInArrow(_chunks(shards), CHUNKS).write.partitionBy("shard").option("compression", "zstd").parquet(path))
    all_ = spark.read.schema(CHUNKS).parquet(path)
    maps = {0: np.zeros(2 ** BITS // 64, np.uint64)}
    sent = {0: spark.sparkContext.broadcast(maps[0])}
    counters, step = None, 0
    while True:
        scan = all_.where(F.col("shard") == step % shards).drop("shard")
        seen = {u: b for u, b in sent.items() if step - shards <= u <= step}
        found = scan.mapInArrow(_counted(step, shards, seen), "lang string, phrase string, n long, since int")
        if counters is not None:
            found = found.unionByName(counters)
        # the tasks have summed their counts, and the counters are distinct: no second sum before the shuffle
        summed = found.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("n"), F.min("since").alias("since"))
        active = F.col("since") + shards > step + 1
        counters = settled(summed.where(active | (F.col("n") >= threshold) | (F.col("phrase") == "")), f"scan-{step}")
        reached = counters.where((F.col("n") >= threshold) & (F.col("phrase") != "") & (F.size(_words_of("phrase")) < LONGEST))
        slots = (reached.select("lang", "phrase").mapInPandas(_bits(BITS), "slot long, bits long")
                 .groupBy("slot").agg(F.bit_or("bits").alias("bits")).toPandas())
        step += 1
        maps[step] = np.zeros(2 ** BITS // 64, np.uint64)
        maps[step][slots["slot"].to_numpy(np.int64)] = slots["bits"].to_numpy(np.int64).view(np.uint64)
        if step >= shards and np.array_equal(maps[step], maps[step - shards]):
            return counters.select("lang", "phrase", "n")
        sent[step] = spark.sparkContext.broadcast(maps[step])
        if step - shards - 1 in sent:
            maps.pop(step - shards - 1)
            sent.pop(step - shards - 1).unpersist()


def collocations(docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP, shards: int | None = None) -> DataFrame:
    """Each language's best ``top`` phrases of 2 to LONGEST words: lang, rank,
    phrase, a (its count), l and r (those of its parts at the cut that scores
    least), n (words of the language), score = floor(2000000 * a / (l + r)).
    Phrases inside a longer one that has 80 % of their count go first."""
    counts = settled(frequent(docs, threshold, shards), "frequent")
    total = counts.where("phrase = ''").select("lang", F.col("n").alias("total"))
    found = counts.where("phrase <> ''").withColumn("words", _words_of("phrase"))
    phrases = found.where("size(words) > 1").select("lang", "phrase", "words", F.col("n").alias("a"))

    # longer phrases around a phrase: the largest count of any
    inner = ("flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), "
             "s -> array_join(slice(words, s, m), ' '))))")
    around = (phrases.where("size(words) > 2").select("lang", F.explode(F.expr(inner)).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    own = phrases.join(around, ["lang", "phrase"], "left").where(
        "longer is null or cast(longer as decimal(20, 0)) * 100 < cast(a as decimal(20, 0)) * 80")

    cuts = own.select("lang", "phrase", "a", "words", F.explode(F.expr("sequence(1, size(words) - 1)")).alias("cut")).select(
        "lang", "phrase", "a", "cut", F.expr("array_join(slice(words, 1, cut), ' ')").alias("left"),
        F.expr("array_join(slice(words, cut + 1, size(words)), ' ')").alias("right"))
    part = found.select("lang", "phrase", "n")
    cuts = (cuts.join(part.toDF("lang", "left", "l"), ["lang", "left"]).join(part.toDF("lang", "right", "r"), ["lang", "right"])
            .withColumn("score", F.expr("(cast(a as decimal(20, 0)) * 2000000) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")))
    scored = (cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
              .select("lang", "phrase", "a", "low.l", "low.r", F.col("low.score").cast("long").alias("score")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top).join(total, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"))
