"""Token ids in binary files: a static range asymmetric numeral system.

A shard is a run of documents in ascending doc_id order. Its blocks hold whole
documents, up to ``BLOCK`` tokens (a longer document has a block of its own).
Every block is coded on its own with the corpus' shared frequency table, as
``lanes`` interleaved states that numpy steps together; checkpoints (all states
and the place in the words) let a reader start inside a block, and a crc32
over the block's bytes tells damage. Block layout, little-endian:

    magic "RNT1", uint32: tokens, lanes, steps from checkpoint to checkpoint,
        checkpoints, words, crc32 of the table
    states before step 0 (uint64 a lane)
    checkpoints: place in the words (uint32), then the states (uint64 a lane)
    words (uint32)
    crc32 of all bytes before (uint32)

The files are Parquet, so that any store Spark reaches can hold them:
``blocks`` (shard, block, start in the shard, doc_ids, lengths, bytes) and
``table`` (id, freq). The table has at most a row for each id of the
vocabulary, which bounds what the driver and the tasks hold of it.

Defined results: null text is empty; an empty text has the end id alone;
null doc_ids come first; rows that repeat a doc_id follow each other in the
order of their ids' crc32; no rows give no blocks and an empty table. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from newsdesk.llm.common import partitions, settled
from newsdesk.llm.tokens import as_array, encoder
from newsdesk.session import ensure_checkpoint_dir

BLOCK, LANES, EVERY = 1 << 18, 2048, 64
SCALE = 18  # bits of the frequencies' sum
LOW = 31  # a state is in [2**31, 2**63) between steps
HEAD = struct.Struct("<4s6I")
BLOCKS = "shard int, block int, start long, doc_ids array<long>, lengths array<int>, bytes binary"


class Table:
    """Frequencies scaled to 2**SCALE; ids that never occur have none."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64) if len(freq) else self.freq
        self.crc = zlib.crc32(freq.astype("<u4").tobytes())

    def symbols(self) -> np.ndarray:
        """The id of each slot."""
        return np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))


def scaled(counts: np.ndarray) -> np.ndarray:
    """Whole frequencies that sum to 2**SCALE, one at least for what occurs."""
    counts = np.asarray(counts, np.float64)
    has = counts > 0
    if not has.any():
        return np.zeros(len(counts), np.int64)
    room = (1 << SCALE) - int(has.sum())
    if room < 0:
        raise ValueError(f"more than {1 << SCALE} distinct ids")
    freq = np.where(has, 1 + np.floor(counts / counts.sum() * room), 0).astype(np.int64)
    freq[int(np.argmax(counts))] += (1 << SCALE) - int(freq.sum())
    return freq


def encode_block(ids: np.ndarray, table: Table, lanes: int = LANES, every: int = EVERY) -> bytes:
    n = len(ids)
    lanes = max(1, min(lanes, n // 64))
    steps = -(-n // lanes)
    freq, cum = table.freq[ids], table.cum[ids]
    if n and not freq.min():
        raise ValueError("an id that the table doesn't have")
    x = np.full(lanes, 1 << LOW, np.uint64)
    words, emitted, marks = [], 0, []
    for t in range(steps - 1, -1, -1):
        s = slice(t * lanes, min(n, (t + 1) * lanes))
        f, y = freq[s], x[:s.stop - s.start]
        full = y >= (f << np.uint64(LOW + 32 - SCALE))
        if full.any():
            words.append((y[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            emitted += len(words[-1])
            y[full] >>= np.uint64(32)
        q = y // f
        y[:] = (q << np.uint64(SCALE)) + (y - q * f) + cum[s]
        if t and t % every == 0:
            marks.append((emitted, x.astype("<u8").tobytes()))
    body = [HEAD.pack(b"RNT1", n, lanes, every, len(marks), emitted, table.crc), x.astype("<u8").tobytes()]
    body += [struct.pack("<I", emitted - at) + states for at, states in reversed(marks)]
    body += [w.tobytes() for w in reversed(words)]
    out = b"".join(body)
    return out + struct.pack("<I", zlib.crc32(out))


def decode_block(block: bytes, table: Table, symbols: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """The tokens of a block, or of the steps between two checkpoints:
    ``first`` and ``last`` count checkpoints (0: the block's start)."""
    if zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("damaged block")
    magic, n, lanes, every, marks, n_words, crc = HEAD.unpack_from(block)
    if magic != b"RNT1" or crc != table.crc:
        raise ValueError("not a block of this table")
    size, at = 8 * lanes, HEAD.size
    words = np.frombuffer(block, "<u4", n_words, at + size + marks * (4 + size))
    pos = 0
    if first:
        at += size + (first - 1) * (4 + size)
        pos, at = struct.unpack_from("<I", block, at)[0], at + 4
    x = np.frombuffer(block, "<u8", lanes, at).astype(np.uint64)
    end = -(-n // lanes) if last is None or last > marks else last * every
    out = np.empty(max(0, min(n, end * lanes) - first * every * lanes), np.uint32)
    for t in range(first * every, end):
        m = min(n, (t + 1) * lanes) - t * lanes
        y = x[:m]
        slot = y & np.uint64((1 << SCALE) - 1)
        s = symbols[slot]
        out[(t - first * every) * lanes:][:m] = s
        y[:] = table.freq[s] * (y >> np.uint64(SCALE)) + slot - table.cum[s]
        if k := int((less := y < np.uint64(1 << LOW)).sum()):
            y[less] = (y[less] << np.uint64(32)) | words[pos:pos + k]
            pos += k
    return out


def encoded_ids(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id, crc (of the narrow ids), ids as uint16 where the vocabulary
    allows it, else as uint32; the end id closes each. One row more for each
    partition, of width 0, has how often each id (``id``, ``n``) occurs in it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        narrow = "<u2" if enc.tokenizer.get_vocab_size(True) <= 1 << 16 and end_id < 1 << 16 else "<u4"
        end = np.array([end_id], "<u4").tobytes()
        total = np.zeros(max(enc.tokenizer.get_vocab_size(True), end_id + 1), np.int64)
        for b in batches:
            ids = [as_array(enc.ids(t) + end).astype(narrow) for t in b["text"].tolist()]
            for part in ids:
                if len(part) > 4096:
                    total += np.bincount(part, minlength=len(total))
            if short := [part for part in ids if len(part) <= 4096]:
                total += np.bincount(np.concatenate(short), minlength=len(total))
            ids = [part.tobytes() for part in ids]
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "crc": list(map(zlib.crc32, ids)), "ids": ids,
                                "width": int(narrow[-1]), "id": None, "n": None})
        has = np.flatnonzero(total)
        yield pd.DataFrame({"doc_id": pd.array([None], "Int64"), "crc": [0], "ids": [b""], "width": [0], "id": [has], "n": [total[has]]})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(
        run, "doc_id long, crc long, ids binary, width int, id array<int>, n array<long>")


def counts(ids: DataFrame) -> DataFrame:
    """id, n: how often each id occurs, over all documents."""
    return (ids.where("width = 0").select(F.explode(F.arrays_zip("id", "n")).alias("x"))
            .groupBy("x.id").agg(F.sum("x.n").alias("n")))


def write(docs: DataFrame, path: str, to: str, end_id: int = 2) -> None:
    """Encode all documents and write the files to the folder ``to``."""
    spark = docs.sparkSession
    ids = settled(encoded_ids(docs, path, end_id), "ids")
    found = {r[0]: r[1] for r in counts(ids).collect()}
    freq = scaled(np.array([found.get(i, 0) for i in range(max(found, default=-1) + 1)]))
    spark.createDataFrame([(i, int(f)) for i, f in enumerate(freq) if f], "id int, freq int").coalesce(1).write.parquet(f"{to}/table")

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, shard = Table(freq), TaskContext.get().partitionId()
        start = block = 0
        names, parts, held = [], [], 0

        def cut() -> pd.DataFrame:
            nonlocal start, block, names, parts, held
            row = pd.DataFrame({"shard": [shard], "block": [block], "start": [start], "doc_ids": [names],
                                "lengths": [[len(p) for p in parts]], "bytes": [encode_block(np.concatenate(parts), table)]})
            start, block, names, parts, held = start + held, block + 1, [], [], 0
            return row

        for b in batches:
            for doc_id, i, w in zip(b["doc_id"].astype("Int64").tolist(), b["ids"].tolist(), b["width"].tolist()):
                part = np.frombuffer(i, f"<u{w}")
                if held and held + len(part) > BLOCK:
                    yield cut()
                names.append(None if doc_id is pd.NA else doc_id)
                parts.append(part)
                held += len(part)
        if held:
            yield cut()

    (ids.where("width > 0").select("doc_id", "crc", "ids", "width")
     .repartitionByRange(partitions(spark), "doc_id", "crc").sortWithinPartitions("doc_id", "crc")
     .mapInPandas(blocks, BLOCKS).write.parquet(f"{to}/blocks"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids: from the
    files of a folder, a block at a time."""
    rows = spark.read.parquet(f"{path}/table").collect()  # a row for each id that occurs
    freq = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        freq[r["id"]] = r["freq"]
    files = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    size = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    # one row for each shard, as many as the write had partitions: small enough to broadcast, so blocks aren't shuffled
    shards = files.groupBy("shard").agg(F.sum(size).alias("n")).select(
        "shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Table(freq)
        symbols = table.symbols()
        for b in batches:
            for at, names, lengths, block in zip(b["start"], b["doc_ids"], b["lengths"], b["bytes"]):
                ids = decode_block(bytes(block), table, symbols).astype("<u4")
                ends = np.cumsum(lengths)
                yield pd.DataFrame({
                    "doc_id": pd.array([None if x is None or x != x else int(x) for x in names], "Int64"),
                    "start": at + ends - lengths, "n_tokens": lengths,
                    "ids": [p.tobytes() for p in np.split(ids, ends[:-1])]})

    return (files.join(F.broadcast(shards), "shard").select((F.col("start") + F.col("before")).alias("start"), "doc_ids", "lengths", "bytes")
            .mapInPandas(run, "doc_id long, start long, n_tokens long, ids binary"))


def new_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/token-files-{uuid.uuid4().hex}"
