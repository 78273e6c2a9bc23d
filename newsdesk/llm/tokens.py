"""Encoding whole texts with a public tokenizer file, chunk by chunk.

The tokenizers library encodes one chunk of a text without regard to the
others wherever a pre-token must end, so each worker keeps the ids of the
chunks it has met. Cuts are made only where every pre-tokenizer used here ends
a pre-token: at white space (Unicode White_Space, written out below, as regex
engines differ on it), and between a Latin letter and closing punctuation (or
some symbols, as a word with them need not be met anew) that white space follows. Strings of added tokens are matched first, as the library
does it.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

WS = "\t-\r \x85\xa0  -     　"
LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
PLAIN = f"[{LETTERS}]+(?=[.,;:!?|#*$%&]*(?:[{WS}]|\\Z))"
#: Chunks of a tokenizer that drops white space, and of one that keeps it.
DROPS = re.compile(f"{PLAIN}|[^{WS}]+")
KEEPS = re.compile(f" ?{PLAIN}| ?[^{WS}]+|[{WS}]+(?![^{WS}])|[{WS}]+")
#: Chunks a worker remembers before it starts anew (some 150 MB).
REMEMBERED = 1_000_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    chars = {b: chr(b) for b in shown}
    chars.update({b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in chars)})
    return [chars[b] for b in range(256)]


class Encoder(dict):
    """``ids(text)``: the ids of a text as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.lowers = "Lowercase" in json.dumps(spec["normalizer"])
        self.pattern = DROPS if spec["normalizer"] else KEEPS
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.plain = re.compile(f" ?[{LETTERS}]+\\Z")
        self.shown = dict(enumerate(byte_alphabet()))

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        # one pre-token: straight to the merges (most chunks are ASCII letters, which need no pattern)
        plain = chunk.isascii() and (chunk if chunk[0] != " " else chunk[1:]).isalpha()
        if plain or self.plain.match(chunk):
            text = chunk.lower() if self.lowers else chunk
            if not plain and not text.isascii():
                text = text.encode().decode("latin-1").translate(self.shown)
            elif text[0] == " ":
                text = self.shown[32] + text[1:]
            found = array("I", [t.id for t in self.model.tokenize(text)]).tobytes()
        else:
            found = array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        if len(chunk) <= 64:
            self[chunk] = found
        return found

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.added is not None and "<|" in text and len(parts := self.added.split(text)) > 1:
            return b"".join(self._segment(p) for p in parts if p)
        return b"".join(map(self.__getitem__, self.pattern.findall(text)))

    def _segment(self, part: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pattern.findall(part))) if not self.added.fullmatch(part) \
            else array("I", [self.tokenizer.token_to_id(part)]).tobytes()


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder for each file and worker process."""
    return Encoder(path)


def as_array(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u4")
