"""BPE encoding and decoding of whole texts, long ones by tree concatenation.

A text of up to ``leaf`` characters is encoded as it stands. A longer one is
halved until its parts are no longer than that; the parts are encoded in
parallel, as rows of their own, and joined pairwise up the tree. At a join the
text around the cut is encoded anew in a window that grows until both sides
agree exactly:

* where white space is near, the window reaches from white space to white
  space, and must give the ids that both sides end and begin with there;
* inside a long run of letters (no white space, nothing a pre-token ends at)
  the window is a number of tokens on each side, and agrees when the pairs of
  tokens across its two edges are encodings of themselves. Every pair inside
  either side or the window is one already, and a sequence of which that holds
  for each pair is the encoding of the whole run.

Defined results: null text is empty; an empty text has no ids and decodes to
an empty text; repeated rows give a row each; a null doc_id stays null; no rows
give no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from newsdesk.llm.common import partitions
from newsdesk.llm.tokens import WS, Encoder, as_array, encoder

LEAF = 16_384
EDGE = regex.compile(f"(?<=[^{WS}])[{WS}](?=[^{WS}])")
RUN = regex.compile(r"\p{L}+")


class Runs:
    """The merges alone, on the printable form of a run of letters; the run's
    end is not marked."""

    def __init__(self, path: str):
        self.enc = encoder(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"].get("end_of_word_suffix") or ""
        spec["model"]["end_of_word_suffix"] = None
        spec.update(normalizer=None, pre_tokenizer=None, post_processor=None, decoder=None, added_tokens=[])
        self.bare = Tokenizer.from_str(json.dumps(spec)).model
        self.shown = {i: t.removesuffix(suffix) for t, i in self.enc.tokenizer.get_vocab(True).items()}

    def ids(self, shown: str) -> list[int]:
        return [t.id for t in self.bare.tokenize(shown)]

    def size(self, text: str) -> int:
        """Characters of the printable form."""
        return len((text.lower() if self.enc.lowers else text).encode())

    def joined(self, left: bytes, right: bytes, before: int, after: int) -> bytes | None:
        """Join two encodings whose texts meet inside a run of letters that
        has ``before`` and ``after`` printable characters on each side; None if
        the window would leave the run."""
        k = 4
        while True:
            a, b = as_array(left[-4 * (k + 1):]).tolist(), as_array(right[:4 * (k + 1)]).tolist()
            if len(a) <= k or len(b) <= k:
                return None
            a, b = [(i, self.shown[i]) for i in a], [(i, self.shown[i]) for i in b]
            if sum(len(t) for _, t in a) > before or sum(len(t) for _, t in b) >= after:
                return None
            window = self.ids("".join(t for _, t in a[1:] + b[:-1]))
            (first, t0), (last, t1) = a[0], b[-1]
            if (self.ids(t0 + self.shown[window[0]]) == [first, window[0]]
                    and self.ids(self.shown[window[-1]] + t1) == [window[-1], last]):
                return left[:-4 * k] + array("I", window).tobytes() + right[4 * k:]
            k *= 2


@lru_cache(maxsize=4)
def _runs(path: str) -> Runs:
    return Runs(path)


def join(runs: Runs, left: tuple[str, bytes], right: tuple[str, bytes]) -> tuple[str, bytes]:
    """Two neighbouring parts (text, ids) as one."""
    (lt, li), (rt, ri) = left, right
    enc, w = runs.enc, 64
    while True:
        lo, hi = max(0, len(lt) - w), min(len(rt), w)
        edges = [m.start() for m in EDGE.finditer(lt, lo)]
        edge = EDGE.search(rt, 0, hi)
        a = edges[-1] if edges else 0 if lo == 0 else None
        b = edge.start() if edge else len(rt) if hi == len(rt) else None
        if a is not None and b is not None:
            tail, head = enc.ids(lt[a:]), enc.ids(rt[:b])
            if (a == 0 or li.endswith(tail)) and (b == len(rt) or ri.startswith(head)):
                front = b"" if a == 0 else li[:len(li) - len(tail)]
                back = b"" if b == len(rt) else ri[len(head):]
                return lt + rt, front + enc.ids(lt[a:] + rt[:b]) + back
        elif w >= 256:
            near = lt[lo:], rt[:hi]
            if all(map(RUN.fullmatch, near)) and unicodedata.is_normalized("NFC", "".join(near)):
                if (ids := runs.joined(li, ri, *map(runs.size, near))) is not None:
                    return lt + rt, ids
        w *= 4


def concatenated(runs: Runs, parts: list[tuple[str, bytes]]) -> bytes:
    """Join the parts of a text pairwise, level by level."""
    while len(parts) > 1:
        parts = [join(runs, *parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0][1] if parts else b""


@lru_cache(maxsize=4)
def _strings(path: str) -> list[str | None]:
    t = encoder(path).tokenizer
    vocab = t.get_vocab(True)
    out: list[str | None] = [None] * (max(vocab.values(), default=-1) + 1)
    for s, i in vocab.items():
        out[i] = s
    return out


def decode(enc: Encoder, path: str, ids: bytes) -> str:
    """The library's decode of all ids; without a decoder it joins the tokens
    with spaces."""
    found = as_array(ids).tolist()
    if enc.tokenizer.decoder is not None:
        return enc.tokenizer.decode(found, skip_special_tokens=False)
    strings = _strings(path)
    return " ".join([strings[i] for i in found])


def encode_and_decode(docs: DataFrame, path: str, leaf: int = LEAF) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit), decoded: per document."""
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    out = "doc_id long, ids binary, decoded string"

    def short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for b in batches:
            ids = [enc.ids(t) for t in b["text"].tolist()]
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "ids": ids,
                                "decoded": [decode(enc, path, i) for i in ids]})

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for b in batches:
            yield b.assign(doc_id=b["doc_id"].astype("Int64"), ids=[enc.ids(t) for t in b["text"].tolist()])

    def tree(group: pd.DataFrame) -> pd.DataFrame:
        runs = _runs(path)
        group = group.sort_values("leaf")
        ids = concatenated(runs, list(zip(group["text"].tolist(), map(bytes, group["ids"].tolist()))))
        return pd.DataFrame({"doc_id": group["doc_id"].astype("Int64").iloc[:1], "ids": [ids],
                             "decoded": [decode(runs.enc, path, ids)]})

    size = F.char_length("text")
    n = F.pow(F.lit(2), F.ceil(F.log2(size / leaf))).cast("int")
    width = F.ceil(size / n).cast("int")
    halved = (docs.where(size > leaf).withColumn("row", F.monotonically_increasing_id())
              .select("doc_id", "row", "text", width.alias("width"), F.explode(F.sequence(F.lit(0), n - 1)).alias("leaf"))
              .select("doc_id", "row", "leaf", F.substring("text", F.col("leaf") * F.col("width") + 1, F.col("width")).alias("text"))
              .repartition(partitions(docs.sparkSession), "row", "leaf"))
    encoded = halved.mapInPandas(leaves, "doc_id long, row long, leaf int, text string, ids binary")
    return docs.where(size <= leaf).mapInPandas(short, out).unionByName(encoded.groupBy("row").applyInPandas(tree, out))
