"""Benchmark decontamination over a distributed positional inverted index.

The index is partitioned by document: each shard holds some hundred documents and, for every word in them, the
ascending list of its positions.  It is made once from the texts alone, so any test set can be searched in
it.  A window of test words is found by taking the list of its rarest word in the shard, shifting it by the
word's offset, and intersecting with the lists of the other words at their offsets; proximity lets these
offsets grow by a bounded number of words between.  Lists of one word are split over all shards, so a word in
every document makes no hot task, and nothing but the written shards and one row for each document moves.

The test set is read in blocks of a bounded number of words, each a pass over the index; a longer item is cut
into pieces that overlap by a window, so what is sent to executors never grows.

Defined cases: a null text has no words; an item without words has no window; a null item_id is ignored;
an item of fewer words than a window is one window; rows that repeat a document, or that have no key, give
results of their own; items that repeat an id count once; clashing input columns are ignored; very long texts
are split into words piece by piece and stay in one shard, some 20 bytes a word; empty tables give empty
results, and an empty test set gives documents without hits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import map_rows, store

WINDOW = 8
#: Foreign words that a proximity match may have between its words.
SLOP = 2
#: A shard ends at so many words or documents.
SHARD_WORDS = 1 << 16
SHARD_DOCS = 512
#: Words of test text searched in one pass: some 30 MB as arrays.
BLOCK_WORDS = 200_000
#: Bytes of a text that are word objects at once, and candidates that are intersected at once.
PIECE_BYTES = 1 << 22
CANDIDATES = 1 << 17

#: Letters and digits of ASCII in lower case and all bytes beyond ASCII make words; the rest separates.
_FOLD = bytes(ord(chr(b).lower()) if chr(b).isalnum() or b > 127 else 32 for b in range(128)) + bytes(range(128, 256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: More than any list's length, for the places behind a short window.
_NEVER = 1 << 30


def pieces_of(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size."""
    raw, at = (text or "").encode("utf-8").translate(_FOLD), 0
    while at < len(raw):
        end = raw.find(b" ", at + PIECE_BYTES)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def words_of(text: str | None) -> list[bytes]:
    return [w for piece in pieces_of(text) for w in piece]


def cut(text: str, hit: dict) -> str:
    """``text`` without the word ranges ``hit["spans"]``; unchanged if it has not the words they were found in."""
    raw = text.encode("utf-8")
    words = [m.span() for m in _WORD.finditer(raw)]
    if len(words) != hit["n_words"]:
        return text
    out, at = [], 0
    for s in hit["spans"]:
        out.append(raw[at : words[s["a"]][0]])
        at = words[s["b"] - 1][1]
    return b"".join([*out, raw[at:]]).decode("utf-8")


def clean(text: str, hit: dict) -> str | None:
    """``cut``, or None for a contaminated text."""
    return None if hit["contaminated"] else cut(text, hit)


class Windows:
    """The distinct windows of a block of test items, and the items that hold each."""

    def __init__(self, items: list[tuple[str, list[bytes]]], width: int = WINDOW):
        self.terms: dict[bytes, int] = {}
        self.names: list[str] = []
        rows, owners = [np.zeros((0, width), np.int32)], [np.zeros(0, np.int32)]
        for name, words in items:
            if not words:
                continue
            ids = np.zeros(max(width, len(words)), np.int32)
            ids[: len(words)] = [self.terms.setdefault(w, len(self.terms) + 1) for w in words]
            rows.append(np.lib.stride_tricks.sliding_window_view(ids, width))
            owners.append(np.full(len(rows[-1]), len(self.names), np.int32))
            self.names.append(name)
        self.matrix, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True) if len(rows) > 1 else (rows[0], owners[0])
        self.lengths = (self.matrix > 0).sum(1)
        pairs = np.unique(np.stack([which.ravel(), np.concatenate(owners)], 1).astype(np.int32), axis=0) if len(rows) > 1 else np.zeros((0, 2), np.int32)
        self.owners = pairs[:, 1]
        self.bounds = np.searchsorted(pairs[:, 0], np.arange(len(self.matrix) + 1))

    def items(self, window: int) -> set[str]:
        return {self.names[i] for i in self.owners[self.bounds[window] : self.bounds[window + 1]]}


INDEX = "shard long, keys array<{kind}>, starts array<long>, n_words array<long>, words binary, counts binary, gaps binary"


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) + 1
        return n


def build_index(df: DataFrame, key: str, text: str, tag: str = "postings") -> DataFrame:
    """Write the positional index of all words: one row for each shard; see INDEX.

    ``words`` are the shard's words, ``counts`` the lengths of their lists and ``gaps`` all lists one after
    another, as differences of positions.  Position 0 is the first word; a gap stands between documents.
    """
    picked = df.select(F.col(key).alias("k"), F.col(text).alias("t"))

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        shard = TaskContext.get().partitionId() << 32
        keys: list = []
        starts: list[int] = []
        lengths: list[int] = []
        parts: list[np.ndarray] = []
        known, at = _Vocabulary(), 0

        def closed() -> tuple:
            ids = np.concatenate(parts)
            counts = np.bincount(ids, minlength=len(known) + 1)
            order = np.argsort(ids, kind="stable")[counts[0] :]  # id 0 is a gap
            return shard, keys, starts, lengths, b"\n".join(known), counts[1:].astype("<i4").tobytes(), np.diff(order, prepend=0).astype("<i4").tobytes()

        for k, t in source:
            n = 0
            for words in pieces_of(t):
                parts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                n += len(words)
            parts.append(np.zeros(1, np.int32))
            keys.append(k)
            starts.append(at)
            lengths.append(n)
            at += n + 1
            if at >= SHARD_WORDS or len(keys) >= SHARD_DOCS:
                yield closed()
                shard += 1
                keys, starts, lengths, parts, known, at = [], [], [], [], _Vocabulary(), 0
        if keys:
            yield closed()

    kind = picked.schema["k"].dataType.simpleString()
    return store(map_rows(picked, INDEX.format(kind=kind), rows), tag)


class Shard:
    """The lists of a shard for the words of some windows."""

    def __init__(self, windows: Windows, starts: list[int], lengths: list[int], words: bytes, counts: bytes, gaps: bytes):
        self.windows = windows
        self.begins = np.asarray(starts, np.int64)
        self.ends = self.begins + np.asarray(lengths, np.int64)
        held = words.split(b"\n") if words else []
        term = np.fromiter((windows.terms.get(w, 0) for w in held), np.int64, len(held))
        n = np.frombuffer(counts, "<i4").astype(np.int64)
        asked = np.flatnonzero(term)
        self.positions = np.cumsum(np.frombuffer(gaps, "<i4"), dtype=np.int64)[np.repeat(term > 0, n)]
        self.counts = np.zeros(len(windows.terms) + 1, np.int64)
        self.counts[term[asked]] = n[asked]
        self.first = np.zeros(len(windows.terms) + 1, np.int64)
        self.first[term[asked]] = np.cumsum(n[asked]) - n[asked]
        self.term_at: np.ndarray = np.zeros(int(self.ends[-1]) + 1 if len(starts) else 0, np.int32)  # in which list a position is
        self.term_at[self.positions] = np.repeat(term[asked], n[asked])

    def matches(self, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Batches of (window, document, start, exact) of all places where a window's words follow in order.

        At most ``slop`` other words stand between them; the match is exact where none does, and only then its
        start is told.
        """
        counts = np.append(self.counts[1:], _NEVER)[self.windows.matrix - 1]  # 0, no word, takes the last
        rarest = counts.argmin(1) if len(counts) else np.zeros(0, np.int64)
        fewest = counts[np.arange(len(counts)), rarest]
        live = np.flatnonzero(fewest)
        sums = np.cumsum(fewest[live])
        at = 0
        while at < len(live):
            done = sums[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sums, done + CANDIDATES, side="right")))
            part = live[at:end]
            window = np.repeat(part, fewest[part])
            within = np.arange(len(window)) - np.repeat(sums[at:end] - fewest[part] - done, fewest[part])
            place = self.positions[self.first[self.windows.matrix[window, rarest[window]]] + within]
            yield self._intersect(window, rarest[window], place, slop)
            at = end

    def _intersect(self, window: np.ndarray, offset: np.ndarray, place: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keep the candidates whose word at ``offset`` is at ``place`` if the lists of the other words agree."""
        n, limit = self.windows.lengths[window], len(self.term_at) - 1
        # row d: can the words so far be had with d others between, behind and before the rarest?
        reach = [np.zeros((slop + 1, len(window)), bool) for _ in range(2)]
        for r in reach:
            r[0] = True
        for k in range(1, self.windows.matrix.shape[1]):
            for side, sign in enumerate((1, -1)):
                j = offset + sign * k
                inside = (j >= 0) & (j < n)
                wanted = self.windows.matrix[window, np.clip(j, 0, n - 1)]
                before = np.logical_or.accumulate(reach[side])
                for d in range(slop + 1):
                    p = place + sign * (k + d)
                    there = (self.term_at[np.clip(p, 0, limit)] == wanted) & (p >= 0) & (p <= limit)
                    reach[side][d] = np.where(inside, before[d] & there, reach[side][d])
            alive = reach[0].any(0) & reach[1].any(0)
            if not alive.all():
                window, offset, place, n = window[alive], offset[alive], place[alive], n[alive]
                reach = [r[:, alive] for r in reach]
        doc = np.searchsorted(self.begins, place, side="right") - 1
        near = np.zeros(len(window), bool)
        for after in range(slop + 1):
            for ahead in range(slop + 1 - after):
                whole = (place - offset - ahead >= self.begins[doc]) & (place + n - 1 - offset + after < self.ends[doc])
                near |= reach[0][after] & reach[1][ahead] & whole
        exact = reach[0][0] & reach[1][0]
        return window[near], doc[near], (place - offset)[near], exact[near]


def _merge(spans: list[tuple[int, int]]) -> list[dict]:
    merged: list[dict] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1]["b"]:
            merged[-1]["b"] = max(merged[-1]["b"], b)
        else:
            merged.append({"a": a, "b": b})
    return merged


HITS = "shard long, place int, {key} {kind}, n_words long, spans array<struct<a:int,b:int>>, items array<string>, near array<string>"


def search(index: DataFrame, key: str, windows: Windows, slop: int = SLOP, every: bool = True) -> DataFrame:
    """HITS of every document, or of those with a match; place is the row's number in the shard.

    ``spans`` are the half-open word ranges of exact matches, merged, and ``items`` their items; ``near`` are the
    items of all matches, proximity included.
    """
    held = index.sparkSession.sparkContext.broadcast(windows)

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        asked = held.value
        for shard, keys, starts, lengths, *lists in source:
            found: dict[int, tuple[set, set, set]] = {}
            for batch in Shard(asked, starts, lengths, *lists).matches(slop):
                for window, doc, start, exact in zip(*(x.tolist() for x in batch), strict=True):
                    spans, items, near = found.setdefault(doc, (set(), set(), set()))
                    near.add(window)
                    if exact:
                        items.add(window)
                        spans.add((start - starts[doc], start - starts[doc] + int(asked.lengths[window])))
            names = lambda chosen: sorted(set().union(*map(asked.items, chosen)))
            for doc in range(len(keys)) if every else sorted(found):
                spans, items, near = found.get(doc, ((), (), ()))
                yield shard, doc, keys[doc], lengths[doc], _merge(spans), names(items), names(near)

    kind = index.schema["keys"].dataType.elementType.simpleString()
    return map_rows(index, HITS.format(key=key, kind=kind), rows)


def proximity(index: DataFrame, key: str, windows: Windows, slop: int) -> DataFrame:
    """(key, items): documents in which some window's words follow in order with at most ``slop`` words between."""
    return search(index, key, windows, slop, every=False).select(key, F.col("near").alias("items"))


def blocks_of(items: DataFrame, item: str, text: str, width: int = WINDOW) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The test set on the driver, block by block, each of at most BLOCK_WORDS words and a window; at least one block."""
    picked = items.select(F.col(item).cast("string").alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t")).filter("i is not null")
    block: list[tuple[str, list[bytes]]] = []
    size, empty = 0, True
    for i, t in picked.toLocalIterator():
        words, at = words_of(t), 0
        while at < len(words):
            piece = words[at : at + BLOCK_WORDS - size + width - 1]
            block.append((i, piece))
            size += len(piece) - width + 1
            if at + len(piece) >= len(words):
                at = len(words)
            else:  # the next piece begins with the first window that this one lacks
                at += len(piece) - width + 1
            if size >= BLOCK_WORDS:
                yield block
                block, size, empty = [], 0, False
    if block or empty:
        yield block


def contamination(docs: DataFrame, key: str, text: str, items: DataFrame, item: str, item_text: str, min_items: int = 2, slop: int = SLOP) -> DataFrame:
    """(key, n_words, n_hit, n_items, items, spans, near, items_sha256, contaminated) of every row.

    ``items`` have a window that occurs, ``near`` one whose words occur in order with at most ``slop`` others between.
    """
    index = build_index(docs, key, text)
    blocks = blocks_of(items, item, item_text)
    block, after = next(blocks), next(blocks, None)
    if after is None:
        found = search(index, key, Windows(block), slop)
    else:
        parts = []
        while block is not None:
            parts.append(store(search(index, key, Windows(block), slop, every=False), "hits"))
            block, after = after, next(blocks, None)
        found = _merged(index, key, reduce(DataFrame.unionByName, parts))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["b"] - x["a"])
    n = F.size("items").cast("long")
    return found.select(key, "n_words", n_hit.alias("n_hit"), n.alias("n_items"), "items", "spans", "near", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n >= min_items).alias("contaminated"))


def _merged(index: DataFrame, key: str, hits: DataFrame) -> DataFrame:
    """HITS of every document from those of several blocks: spans are merged, items united."""
    united = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    by_doc = hits.groupBy("shard", "place").agg(F.flatten(F.collect_list("spans")).alias("spans"), united("items"), united("near"))

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for shard, place, spans, items, near in source:
            yield shard, place, _merge([(s["a"], s["b"]) for s in spans]), items, near

    ddl = "shard long, place int, spans array<struct<a:int,b:int>>, items array<string>, near array<string>"
    every = index.select("shard", "n_words", F.posexplode("keys").alias("place", key))
    joined = every.select("shard", "place", key, F.col("n_words")[F.col("place")].alias("n_words")).join(map_rows(by_doc, ddl, rows), ["shard", "place"], "left")
    filled = [F.coalesce(c, F.array().cast(joined.schema[c].dataType)).alias(c) for c in ("spans", "items", "near")]
    return joined.select("shard", "place", key, "n_words", *filled)
