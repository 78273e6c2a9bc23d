"""Near-duplicate documents by circulant MinHash, confirmed on full sets.

Words are runs of characters other than ASCII white space, A-Z in lower case; a
document's set is its distinct shingles of ``width`` words (with fewer words,
the whole sequence as one). Documents link where 100 * |intersection| >=
100 * ``similarity`` * |union|, and the connected components are returned.

One permutation places each shingle on the circle of 2**32 positions; a second
one, shifted by k around the circle, gives coordinate k of the signature: the
least image of the set. Runs of ``ROWS`` coordinates are the bands; with 28
bands of 4 a pair at 0.8 shares none with a chance of 4e-7. What is hashed to
64 bits or more is taken as equal when the hashes are.

Documents of one set collapse into a class first, so copies cost nothing
further. Classes that share a band are a bucket. Pairs in a bucket are never
all written out:

1. every bucket's members are compared with its centre, the member whose
   buckets hold most classes (of a group of near copies, what they are copies
   of): by signature first, and where those agree as nearly as a pair at the
   limit would (five standard deviations below it), on their full sets;
2. the same with a second centre, the best of those that are not in the first
   centre's component;
3. members of one bucket that are still in different components (a bucket of
   two whose pair was compared is done) are compared by signature, block by
   block, inside the tasks, and those that agree with another as nearly are
   compared on full sets, in the same blocks: a product of
   shingle matrices has the intersections of all pairs of a block. Only links
   are written out. Nothing is left out, and a bucket is split into blocks of
   about ``BLOCK`` members.

Only texts of documents that are compared on full sets are moved: a bitmap of
their hashed ids, bounded in size, sifts the input where it is read, and an
exact join follows.

Defined results: null, empty and blank texts have an empty set and link with
nothing; rows that repeat a doc_id are one document; a null doc_id links with
nothing, has no component and is kept; no rows give no rows. Columns other than
doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from newsdesk.llm.common import settled, unused

WIDTH, SIMILARITY = 5, 0.8
ROWS, BANDS = 4, 28
BLOCK = 256
HOT = 1024  # members of a bucket that one task joins with what the bucket has one row of
REMEMBERED = 1_000_000
MOST_BITS = 1 << 27  # of the bitmap of ids
_PART = 1 << 15  # bits in a row of Spark's bitmaps


class _Words(dict):
    """64-bit hashes of the words a worker has met."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_WORDS = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct shingles."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # of bytes: ASCII alone
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = max(1, len(w) - width + 1)
    h = np.full(n, min(len(w), width), np.uint64)
    for i in range(min(len(w), width)):
        h = _mixed((h ^ w[i:i + n]) * np.uint64(0x9E3779B97F4A7C15))
    return np.unique(h)


@lru_cache(maxsize=8)
def _shifts(n: int) -> np.ndarray:
    return np.arange(n, dtype=np.uint32)[:, None]


def signature(hashes: np.ndarray, n: int = ROWS * BANDS) -> np.ndarray:
    """Circulant MinHash: n coordinates of uint32."""
    place = (hashes >> np.uint64(32)).astype(np.uint32)  # the first permutation
    out = np.full(n, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(place), 1024):
        x = place[None, at:at + 1024] + _shifts(n)  # around the circle
        # the second permutation: a bijection of 32 bits
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x7FEB352D)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x846CA68B)
        np.minimum(out, (x ^ (x >> np.uint32(16))).min(axis=1), out=out)
    return out


def _coarse(sig: np.ndarray) -> bytes:
    """16 bits a coordinate."""
    return (sig & np.uint32(0xFFFF)).astype("<u2").tobytes()


def _bands(sigs: np.ndarray) -> np.ndarray:
    """The band hashes of coarse signatures (rows of uint16)."""
    parts = sigs.reshape(len(sigs), BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for i in range(ROWS):
        h = _mixed((h ^ parts[:, :, i]) * np.uint64(0x9E3779B97F4A7C15))
    return h.view(np.int64)


def _sigs(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column.tolist()), "<u2").reshape(len(column), ROWS * BANDS)


def sketched(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, set_key (null: empty), sig (16 bits a coordinate)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for text in b["text"].tolist():
                h = shingles(text, width)
                if not len(h):
                    rows.append((0, None, None))
                    continue
                rows.append((len(h), xxhash.xxh128_digest(h.tobytes()), _coarse(signature(h))))
            yield pd.DataFrame(rows, columns=["n_shingles", "set_key", "sig"]).assign(doc_id=b["doc_id"].astype("Int64"))

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInPandas(run, "n_shingles long, set_key binary, sig binary, doc_id long"))


def buckets(sigs: DataFrame) -> DataFrame:
    """bucket, id: a row for each band."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"bucket": _bands(_sigs(b["sig"])).reshape(-1), "id": np.repeat(b["id"].to_numpy(), BANDS)})

    return sigs.select("id", "sig").mapInPandas(run, "bucket long, id long")


def _least(similarity: float) -> int:
    """Coordinates that a pair at the limit shares, less five standard deviations."""
    n = ROWS * BANDS
    return math.floor(n * similarity - 5 * math.sqrt(n * similarity * (1 - similarity)))


def _bitmap(ids: DataFrame) -> tuple[DataFrame, int]:
    """part, bits: a bitmap of the hashed ids (column id); its size in bits. Some
    16 bits an id and ``MOST_BITS`` at most, whatever the input."""
    n = min(MOST_BITS, max(_PART, 1 << (16 * ids.count()).bit_length()))
    at = F.pmod(F.xxhash64("id"), F.lit(n))
    return ids.select(F.floor(at / _PART).alias("part"), (at % _PART).alias("at")).groupBy("part").agg(F.bitmap_construct_agg("at").alias("bits")), n


def sifted(df: DataFrame, id_: Column, bitmap: tuple[DataFrame, int], how: str = "left_semi") -> DataFrame:
    """The rows whose id has its bit set (or, by "left_anti", has not): all that
    are in the bitmap and few others. Nothing is shuffled."""
    bits, n = bitmap
    part, bits_ = unused(df, "part"), unused(df, "bits")
    bits = bits.select(F.col("part").alias(part), F.col("bits").alias(bits_))
    at = F.pmod(F.xxhash64(id_), F.lit(n))
    place = at % _PART
    byte = F.conv(F.hex(F.substring(F.col(bits_), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return df.join(F.broadcast(bits), (F.floor(at / _PART) == F.col(part)) & (F.bit_get(byte, (place % 8).cast("int")) == 1), how)


def plausible(pairs: DataFrame, sigs: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose signatures agree as nearly as those of a pair at
    the limit would. An id with several signatures is held by any of them."""
    least = _least(similarity)
    both = (pairs.join(sigs.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b")
            .join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in batches:
            if len(g):
                yield g.loc[(_sigs(g["sig_a"]) == _sigs(g["sig_b"])).sum(axis=1) >= least, ["a", "b"]]

    return both.mapInPandas(run, "a long, b long").distinct()


def confirmed(pairs: DataFrame, docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of doc_ids whose full sets link."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    texts = settled(sifted(docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")), F.col("id"), _bitmap(ids)), "texts")
    both = (pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a"))
    percent = round(100 * similarity)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, x = None, None
        for g in batches:
            good = []
            for a, ta, tb in zip(g["a"].tolist(), g["text_a"].tolist(), g["text_b"].tolist()):
                if last is None or last[0] != a or last[1] != ta:  # rows come by a
                    last, x = (a, ta), shingles(ta, width)
                y = shingles(tb, width)
                common = len(np.intersect1d(x, y, assume_unique=True))
                union = len(x) + len(y) - common
                good.append(union > 0 and 100 * common >= percent * union)
            yield g.loc[good, ["a", "b"]]

    return both.mapInPandas(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """id, label (the smallest id of its component) for the ids of the edges
    (a, b), by least labels of neighbours and shortcuts, a written table a
    round; a centre with very many edges is one row on one side of a join."""
    both = settled(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = settled(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["id"]).groupBy(both["a"].alias("id")).agg(F.min("label").alias("near")))
        least = labels.join(near, "id", "left").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("id").alias("label"), F.col("label").alias("up"))
        new = settled(least.join(up, "label", "left").select("id", "old", F.least("label", "up").alias("label")), "labels")
        labels = new.select("id", "label")
        if not new.where("old <> label").limit(1).count():
            return labels


def _labelled(members: DataFrame, edges: DataFrame, tried: DataFrame) -> DataFrame:
    """The members of buckets with their component's label, of those buckets
    alone that have more than one and are not a pair that was tried."""
    labels = components(edges)
    out = members.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    mixed = out.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max("n").alias("n"),
                                       F.min("id").alias("a"), F.max("id").alias("b")).where("low <> high")
    done = mixed.where("n = 2").join(tried, ["a", "b"], "left_semi").select("bucket")
    return _meet(out, mixed.join(done, "bucket", "left_anti").select("bucket", "n"))


def _meet(members: DataFrame, buckets: DataFrame) -> DataFrame:
    """The members (bucket, id, n) with the row that ``buckets`` (bucket, n) has
    of their bucket. A bucket of very many members is split by a salt, and its
    row is repeated for each part."""
    parts = lambda n: F.ceil(n / HOT).cast("long")
    salted = members.withColumn("salt", F.pmod(F.xxhash64("id"), parts(F.col("n"))))
    each = buckets.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), parts(F.col("n")) - 1))).drop("n")
    return salted.join(each, ["bucket", "salt"]).drop("salt")


def _centred(members: DataFrame) -> DataFrame:
    """bucket, and its member with the greatest mass."""
    return members.groupBy("bucket").agg(F.max("n").alias("n"), F.max(F.struct(F.col("mass"), (-F.col("id")).alias("neg"))).alias("top")).select(
        "bucket", "n", (-F.col("top.neg")).alias("centre"))


def _pairs(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _groups(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Frames of whole groups (runs of one value of g), of about ``rows`` rows
    where the groups allow it."""
    held, n = [], 0
    for b in batches:
        if not len(b):
            continue
        held.append(b)
        n += len(b)
        if n < rows:
            continue
        all_ = pd.concat(held, ignore_index=True)
        g = all_["g"].to_numpy()
        last = int(np.flatnonzero(g != g[-1])[-1]) + 1 if g[0] != g[-1] else 0
        if last:
            yield all_.iloc[:last]
        held, n = [all_.iloc[last:]], len(all_) - last
    if n:
        yield pd.concat(held, ignore_index=True)


def _met(g: pd.DataFrame, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether rows x and y are of one group, of different components, and of
    the two blocks that the group has meet."""
    of, label, block, same = g["g"].to_numpy(), g["label"].to_numpy(), g["block"].to_numpy(), g["same"].to_numpy()
    return (of[x] == of[y]) & (label[x] != label[y]) & (same[x] | (block[x] != block[y]))


def _alike(least: int):
    """Rows of a group whose signature agrees with another's. Two that share
    several buckets are compared in the first of them alone."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in _groups(batches, 8192):
            sig = _sigs(g["sig"])
            bands, bucket = _bands(sig), g["bucket"].to_numpy()
            of = g["g"].to_numpy()
            starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            longest = int(np.diff(np.r_[starts, len(of)]).max())
            hit = np.zeros(len(g), bool)
            for d in range(1, longest):  # row k with row k + d, for all groups at once
                x = np.arange(len(g) - d)
                x = x[of[x] == of[x + d]]
                x = x[_met(g, x, x + d)]
                for at in range(0, len(x), 4096):
                    k = x[at:at + 4096]
                    k = k[(sig[k] == sig[k + d]).sum(axis=1) >= least]
                    both = bands[k] == bands[k + d]
                    first = bands[k, both.argmax(axis=1)]
                    k = k[(first == bucket[k]) | ~both.any(axis=1)]  # none: of an id with several texts
                    hit[k] = hit[k + d] = True
            yield g.loc[hit, ["g", "id", "label", "block", "same"]]
    return run


def _linked(percent: int):
    """Pairs of a group's rows that link, on full sets."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for many in _groups(batches, 1):
            for _, g in many.groupby("g", sort=False):
                sets = [np.frombuffer(h, "<u8") for h in g["hashes"]]
                ids, size = g["id"].to_numpy(), np.array([len(h) for h in sets])
                all_ = np.concatenate(sets)
                values, place, seen = np.unique(all_, return_inverse=True, return_counts=True)
                owner, common = np.repeat(np.arange(len(sets)), size), np.zeros((len(sets), len(sets)))
                shared = np.flatnonzero(seen > 1)  # the others are in no intersection
                column = np.full(len(values), -1)
                for at in range(0, len(shared), 8192):
                    column[:] = -1
                    part = shared[at:at + 8192]
                    column[part] = np.arange(len(part))
                    has = column[place] >= 0
                    m = np.zeros((len(sets), len(part)), np.float32)
                    m[owner[has], column[place[has]]] = 1
                    common += m @ m.T
                x, y = np.nonzero(np.triu(100 * common >= percent * (size[:, None] + size[None, :] - common), 1))
                ok = _met(g, x, y)
                yield pd.DataFrame({"a": np.minimum(ids[x], ids[y])[ok], "b": np.maximum(ids[x], ids[y])[ok]})
    return run


def _across(members: DataFrame, sigs: DataFrame, docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """The links between members of a bucket with different labels."""
    sizes = members.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = (members.join(sizes, "bucket").join(sigs, "id")
              .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
    # each block meets every block once; a group holds the two that meet
    meets = placed.select("id", "label", "sig", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), "bucket").select(
        F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")).alias("g"),
        "id", "label", "block", (F.col("block") == F.col("other")).alias("same"), "sig", "bucket")
    # a pair of different blocks needs no row against its own block: that is the group of the block with itself
    near = settled(meets.repartition("g").sortWithinPartitions("g").mapInPandas(
        _alike(_least(similarity)), "g long, id long, label long, block int, same boolean"), "alike")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "hashes": [shingles(t, width).astype("<u8").tobytes() for t in b["text"].tolist()]})

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    ids = near.select("id").distinct()
    full = sifted(texts, F.col("id"), _bitmap(ids)).join(ids, "id").mapInPandas(sets, "id long, hashes binary")
    return (near.join(full, "id").repartition("g").sortWithinPartitions("g")
            .mapInPandas(_linked(round(100 * similarity)), "a long, b long").distinct())


def near_duplicates(docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    rows = settled(sketched(docs, width), "sketches")
    full = rows.where("set_key is not null and doc_id is not null")
    # documents of one set have one signature
    classes = settled(full.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig")), "classes")
    sigs = classes.select("id", "sig")  # an id with several texts has several rows
    found = buckets(sigs).repartition("bucket")
    sizes = found.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high").select("bucket", "n")
    shared = settled(found.join(sizes, "bucket").distinct(), "shared")
    members = settled(shared.join(shared.groupBy("id").agg(F.sum("n").alias("mass")), "id").select("bucket", "id", "mass", "n"), "buckets")

    def with_centre(m: DataFrame, centres: DataFrame) -> DataFrame:
        near = _meet(m, centres).where(F.col("id") != F.col("centre"))
        if "label" in m.columns:
            near = near.where(F.col("label") != F.col("of"))
        return near.select(*_pairs(F.col("id"), F.col("centre"))).distinct()

    tried = settled(with_centre(members, _centred(members)), "pairs")
    edges = settled(confirmed(settled(plausible(tried, sigs, similarity), "plausible"), docs, width, similarity), "links")

    left = settled(_labelled(members, edges, tried), "mixed")
    first = _centred(left).join(left.select("bucket", F.col("id").alias("centre"), "label"), ["bucket", "centre"]).select("bucket", "n", F.col("label").alias("first"))
    second = _centred(_meet(left, first).where("label <> first"))
    second = second.join(left.select("bucket", F.col("id").alias("centre"), F.col("label").alias("of")), ["bucket", "centre"])
    more = settled(with_centre(left, second).join(tried, ["a", "b"], "left_anti"), "pairs")
    edges = settled(edges.union(confirmed(settled(plausible(more, sigs, similarity), "plausible"), docs, width, similarity)), "links")

    left = settled(_labelled(left.select("bucket", "id", "mass", "n"), edges, tried.union(more)), "mixed")
    edges = settled(edges.union(_across(left, sigs, docs, width, similarity)), "links")

    # rows that repeat a doc_id with different texts are linked as one document
    same = full.join(classes.select("set_key", "id"), "set_key").where("doc_id <> id").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    twice = full.groupBy("doc_id").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high")).where("low <> high").select("doc_id")
    edges = edges.union(same.join(twice, same["b"] == twice["doc_id"]).select("a", "b"))
    labels = components(edges)
    of_class = classes.select("set_key", "id").join(labels, "id", "left").select("set_key", F.coalesce("label", "id").alias("component"))
    out = rows.select("doc_id", "n_shingles", "set_key").join(of_class, "set_key", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
                      F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))


def keep(docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of one document of each group, with the columns of ``docs``."""
    name = unused(docs, "gone")
    gone = settled(near_duplicates(docs, width, similarity).where("not kept").select(F.col("doc_id").alias("id")).distinct(), "gone")
    bitmap, id_ = _bitmap(gone), F.col("doc_id").cast("long")
    maybe = sifted(docs, id_, bitmap).join(gone.select(F.col("id").alias(name)), id_ == F.col(name), "left_anti")
    return sifted(docs, id_, bitmap, "left_anti").union(maybe)
