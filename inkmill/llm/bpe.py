"""Byte-level BPE by backtracking.

Bytes map to Latin-1 characters, so one Aho-Corasick automaton over the vocabulary finds the longest
token at every byte.  The encoder walks from left to right, takes the longest token, and steps back to
shorter ones wherever a token may not follow its neighbour.  Whether two tokens may stand side by side is
decided once by merging their joined bytes, and remembered.  A position found dead is never tried again,
so the work is linear in the piece, and the outcome equals that of merging by rank.

Defined cases: a null or empty text has no tokens; very long pieces (one word of megabytes) take linear
time and memory; repeated rows give repeated results; other input columns are ignored; an empty table gives
an empty table.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import map_rows

#: Entries of a memo's young half, and so of its old one; memory stays bounded on any corpus.
PIECES = 1 << 17
PAIRS = 1 << 18


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file, which lies beside the interpreter's packages on every machine."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Memo(dict):
    """Results on demand, in two halves: when the young one is full it becomes the old one, from which what is asked for returns."""

    def __init__(self, compute, size: int):
        super().__init__()
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.compute(key)
        if not isinstance(key, str) or len(key) <= 64:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.split = regex.compile(pattern)
        self.pairs = Memo(self._adjacent, PAIRS)  # by both ids as one number
        #: piece -> its ids as little-endian 32-bit bytes
        self.pieces = Memo(lambda piece: array("I", self.encode_piece(piece.encode("utf-8"))).tobytes(), PIECES)
        # tokens that merging never makes can only stand for a whole piece, which is looked up first
        usable = {token: rank for token, rank in ranks.items() if len(token) == 1 or self.merge(token) == [rank]}
        self.machine = ahocorasick.Automaton()
        for token, rank in usable.items():
            self.machine.add_word(token.decode("latin-1"), rank)
        self.machine.make_automaton()
        self.shorter: dict[int, int] = {}
        for token, rank in usable.items():
            for end in range(len(token) - 1, 0, -1):
                if token[:end] in usable:
                    self.shorter[rank] = usable[token[:end]]
                    break

    def merge(self, data: bytes) -> list[int]:
        """Merging by rank, quadratic; used on the few bytes of one or two tokens."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranked = [(self.ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            best, i = min(ranked)
            if best == 1 << 30:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _adjacent(self, pair: int) -> bool:
        """May the token of the low half follow that of the high half?"""
        a, b = pair >> 32, pair & 0xFFFFFFFF
        return self.merge(self.tokens[a] + self.tokens[b]) == [a, b]

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        tokens, pairs, shorter = self.tokens, self.pairs, self.shorter
        longest = array("i", [-1]) * len(data)
        for end, rank in self.machine.iter(data.decode("latin-1")):
            longest[end + 1 - len(tokens[rank])] = rank  # ends ascend, so the last is the longest
        dead = bytearray(len(data) + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < len(data):
            while token >= 0:
                end = at + len(tokens[token])
                if not dead[end] and (not out or pairs[out[-1] << 32 | token]):
                    break
                token = shorter.get(token, -1)
            if token >= 0:
                out.append(token)
                at = end
                if at < len(data):
                    token = longest[at]
            else:
                if not out:
                    raise ValueError("the vocabulary lacks single bytes")
                dead[at] = 1
                last = out.pop()
                at -= len(tokens[last])
                token = shorter.get(last, -1)
        return out

    def encode_bytes(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.split.findall(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per Python worker."""
    return Codec(load_ranks(path), pattern)


def encode_texts(df: DataFrame, key: str, text: str, path: str, pattern: str) -> DataFrame:
    """(key, n_tokens, ids): ids hold little-endian unsigned 32-bit integers."""

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        c = codec(path, pattern)
        for k, t in source:
            ids = c.encode_bytes(t or "")
            yield k, len(ids) // 4, ids

    picked = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return map_rows(picked, f"{key} {picked.schema['k'].dataType.simpleString()}, n_tokens long, ids binary", rows)


def round_trip(df: DataFrame, key: str, text: str, path: str, pattern: str, keep: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]): encode, decode the ids, and digest both.

    One Python pass does both directions, so ids never travel between JVM and Python unless kept.
    """

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        c = codec(path, pattern)
        for k, t in source:
            ids = c.encode_bytes(t or "")
            back = c.decode(ids)
            head = k, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()
            yield (*head, ids, back.decode("utf-8")) if keep else head

    picked = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = picked.schema["k"].dataType.simpleString()
    return map_rows(picked, f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * keep, rows)
