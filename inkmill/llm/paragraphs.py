"""Repeated paragraphs and passages, by paragraph MinHash banding.

Paragraphs are lines of at least SHINGLE words, so all lines that have a shingle.  Their five-word shingles
get MinHash signatures, cut in BANDS bands of ROWS rows: two paragraphs of Jaccard similarity 0.8 share a
band with probability 0.998.  Those that share a band with others are verified by their exact Jaccard
similarity, and links close to components; each component keeps its first paragraph.

A passage need not fill a line.  Every window of PASSAGE words picks an anchor, the one of its PICK runs of ANCHOR words
that has the least hash, the first of equal ones; so equal windows pick equal anchors at equal places.  The windows that
pick an anchor are one stretch of text.  Where all places of an anchor have equal stretches, these are the common runs;
where they differ, all windows of each different stretch are compared.  Hence every common run of PASSAGE words or more
is found, from its first to its last word.

The removals of a document are its repeated paragraphs of PASSAGE words or more and its passages.  Shorter
paragraphs that repeat, such as licence lines and headings, are told in columns of their own: they make no
class and no removal.

Defined cases: a null text has no paragraphs; a row without a key is ignored; rows that repeat a key are
one document; a paragraph that recurs only within its document is no repetition; a document that shares nothing
is a class of its own; hashes have 64 bits; very long texts are hashed whole, those of a chunk together; clashing
input columns are ignored; an empty table gives an empty table.

At scale: texts move once, by document, to the places whose words must be seen again; else rows of hashes do, in
proportion to the words.  In a band, all paragraphs are compared to two representatives,
then members of different components to each other, where sizes and bitmaps that cannot lose a similar pair
come before the exact test and only similar pairs leave the join; so a band of near copies never emits its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from inkmill.llm import common
from inkmill.llm.common import bound_batches, components, map_rows, release_memory, schema_of, small, store

SHINGLE = 5
SIMILARITY = 0.8
#: Words of a passage; paragraphs of so many words count as such.
PASSAGE = 50
#: Words of an anchor, and of how many neighbouring ones the least is picked: together a passage.
ANCHOR, PICK = 26, 25
BANDS, ROWS = 9, 3
#: Bytes of a table of hashes that may be broadcast; joins with larger ones shuffle rows of hashes.
MEET_BYTES = 8 << 20
#: Bits of the map that stands for a paragraph's shingles before they are compared.
MAP_BITS = 256
#: Words hashed at once.
CHUNK_WORDS = 1 << 18
WORD_MEMO = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


_KEYS = _mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * _U(_BASE)).reshape(-1, 2)


def bitmap(shingles: np.ndarray) -> list[int]:
    """Every shingle sets one of MAP_BITS bits: two maps differ in no more bits than the sets in shingles."""
    bits = np.zeros(MAP_BITS, np.uint8)
    bits[(shingles.view(np.uint64) % _U(MAP_BITS)).astype(np.int64)] = 1
    return np.packbits(bits).view(">i8").astype(np.int64).tolist()


class _Memo(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_MEMO:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word, 1)
        return h


class Hasher:
    """Hashes of word runs: any run's hash is a difference of prefix sums."""

    def __init__(self):
        self.memo = _Memo()
        self.up = self.down = np.ones(0, np.uint64)

    def load(self, words: list[bytes]) -> None:
        n = len(words)
        if len(self.up) <= n:
            size = max(1024, 2 * n)
            self.up = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, _BASE, np.uint64)]))
            self.down = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, _INVERSE, np.uint64)]))
        h = np.fromiter(map(self.memo.__getitem__, words), np.uint64, n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * self.up[:n], dtype=np.uint64)])

    def runs(self, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return _mix(raw + (ends - starts).astype(np.uint64) * _U(0xA0761D6478BD642F) + _U(seed))

    def grams(self, width: int, seed: int) -> np.ndarray:
        starts = np.arange(max(0, len(self.sums) - width))
        return self.runs(starts, starts + width, seed)


def _split(text: str) -> list[list[bytes]]:
    return [line.split() for line in text.encode("utf-8").lower().split(b"\n")]


UNITS = "doc long, start int, n int, hash long, bands array<long>, stretch long"


def _anchors(hashes: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, hash) of every anchor; the windows that pick it follow each other."""
    picks = np.lib.stride_tricks.sliding_window_view(hashes, PICK).argmin(1) + np.arange(len(windows))
    first = np.flatnonzero(np.diff(picks, prepend=-1))
    many = np.diff(first, append=len(picks))
    # of one word over and over, a few: windows like those around them say nothing new and lie inside of others that stay
    same = np.zeros(len(windows), bool)
    equal = windows[1:] == windows[:-1]
    same[2:-1] = equal[:-2] & equal[1:-1] & equal[2:]
    kept = ~(same[first] & (first % ANCHOR > 0))
    first = first[kept]
    return first, many[kept], hashes[picks[first]]


def units(df: DataFrame, key: str, text: str) -> DataFrame:
    """Written table UNITS of every paragraph (with bands) and every anchor (without).

    An anchor's ``start``, ``n`` and ``stretch`` are those of the words of all windows that pick it, ``hash`` is its own.
    """
    spark_schema = schema_of(UNITS)
    arrow = to_arrow_schema(spark_schema)

    def batch(hasher: Hasher, docs: list[tuple[int, list[list[bytes]]]]) -> Iterator[pa.RecordBatch]:
        words: list[bytes] = []
        lines: list[tuple[int, int, int, int]] = []  # document, its first word, start, end
        spans = []
        for key_, parts in docs:
            base = len(words)
            for p in parts:
                if len(p) >= SHINGLE:
                    lines.append((key_, base, len(words), len(words) + len(p)))
                words += p
            spans.append((key_, base, len(words)))
        if not words:
            return
        hasher.load(words)
        grams, windows = hasher.grams(ANCHOR, 1), hasher.grams(PASSAGE, 4)
        found = [(k, a, _anchors(grams[a : b - ANCHOR + 1], windows[a : b - PASSAGE + 1])) for k, a, b in spans if b - a >= PASSAGE]
        if found:
            each = [len(first) for *_, (first, _, _) in found]
            keys, base = (np.repeat(np.array([x[i] for x in found], np.int64), each) for i in range(2))
            starts, many, hashes = (np.concatenate([x[2][i] for x in found]) for i in range(3))
            n = many + PASSAGE - 1
            stretches = hasher.runs(base + starts, base + starts + n, 4)
            none = pa.nulls(len(keys), arrow.field("bands").type)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(starts.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(hashes.view(np.int64)), none, pa.array(stretches.view(np.int64))], schema=arrow)
        if lines:
            keys, base, starts, ends = (np.array(c, np.int64) for c in zip(*lines, strict=True))
            shingles = hasher.grams(SHINGLE, 3)
            flat = np.stack([starts, np.maximum(starts + 1, ends - SHINGLE + 1)], 1).ravel()
            short = (shingles >> _U(32)).astype(np.uint32)
            values = np.zeros(len(short) + 1, np.uint32)  # one more, which no line's range reaches
            bands = np.zeros((BANDS, len(lines)), np.uint64)
            for i, (a, b) in enumerate(_KEYS):
                np.multiply(short ^ np.uint32(a >> _U(32)), np.uint32(b >> _U(32)) | np.uint32(1), out=values[:-1])
                bands[i // ROWS] = _mix(bands[i // ROWS] ^ np.minimum.reduceat(values, flat)[::2].astype(np.uint64)) + _U(i // ROWS + 1)
            offsets = pa.array(np.arange(0, BANDS * len(lines) + 1, BANDS, dtype=np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(bands.T.ravel().view(np.int64)), type=arrow.field("bands").type)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array((starts - base).astype(np.int32)), pa.array((ends - starts).astype(np.int32)), pa.array(hasher.runs(starts, ends, 2).view(np.int64)), lists, pa.nulls(len(lines), pa.int64())], schema=arrow)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, docs, n = Hasher(), [], 0
        for b in source:
            for k, t in zip(b.column(0), b.column(1), strict=True):
                parts = _split(t.as_py())
                docs.append((k.as_py(), parts))
                n += sum(map(len, parts))
                if n >= CHUNK_WORDS:
                    yield from batch(hasher, docs)
                    docs, n = [], 0
        yield from batch(hasher, docs)
        release_memory()

    picked = _texts(df, key, text)
    bound_batches(df.sparkSession)
    return store(picked.mapInArrow(run, spark_schema), "units")


def _texts(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("t")).filter("doc is not null and t is not null")


def _meet(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join with a stored table, which is broadcast where its size allows."""
    return left.join(F.broadcast(right) if small(right, min(MEET_BYTES, common.BROADCAST_BYTES)) else right, on, how)


def _similar(a: Column, b: Column) -> Column:
    """Does the exact Jaccard similarity of two sets reach SIMILARITY?  Sizes alone rule out many pairs."""
    both = F.size(F.array_intersect(a, b))
    sizes = F.size(a) + F.size(b)
    return (F.least(F.size(a), F.size(b)) >= SIMILARITY * F.greatest(F.size(a), F.size(b))) & (both >= SIMILARITY * (sizes - both))


def _verified(pairs: DataFrame, shingles: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` whose exact Jaccard similarity reaches SIMILARITY."""
    one = shingles.select(F.col("hash").alias("a"), F.col("set").alias("sa"))
    two = shingles.select(F.col("hash").alias("b"), F.col("set").alias("sb"))
    return pairs.join(one, "a").join(two, "b").filter(_similar(F.col("sa"), F.col("sb"))).select("a", "b")


FETCHED = "hash long, set array<long>, map array<long>, doc long, at int, stretch long, n int, last long, windows array<long>"


def _stretch(*columns: Column) -> Column:
    """A stretch: its hash and words; the last document that has it, and the hashes of its windows, for one place of each."""
    return F.struct(*(c.cast(kind).alias(name) for c, name, kind in zip(columns, ("stretch", "n", "last", "windows"), ("long", "int", "long", "array<long>"), strict=True))).alias("w")


def fetched(df: DataFrame, key: str, text: str, wanted: DataFrame, ends: DataFrame) -> DataFrame:
    """What the texts themselves must tell, each text read once, as a written table.

    Rows with a hash hold the shingles of the paragraphs ``wanted(hash, doc, start, n)``; the others are all windows
    of the stretches ``ends(doc, start, n, stretch, last)``, as passage_hits takes them.
    """
    none = F.lit(None).cast("long")
    lines = wanted.select("doc", "start", "n", "hash", none.alias("stretch"), none.alias("last"))
    places = lines.unionByName(ends.select("doc", "start", "n", none.alias("hash"), "stretch", "last"))
    by_doc = store(places.groupBy("doc").agg(F.collect_list(F.struct("start", "n", "hash", "stretch", "last")).alias("places")), "places")

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        hasher = Hasher()
        for doc, t, held in source:
            words = t.encode("utf-8").lower().split()
            hasher.load(words)
            for p in held:
                a, b = p["start"], p["start"] + p["n"]
                is_line = p["hash"] is not None
                # rows that repeat a key may have other words there
                if b > len(words) or hasher.runs(np.array([a]), np.array([b]), 2 if is_line else 4).view(np.int64)[0] != p["hash" if is_line else "stretch"]:
                    continue
                if is_line:
                    starts = np.arange(a, max(a + 1, b - SHINGLE + 1))
                    found = np.unique(hasher.runs(starts, starts + SHINGLE, 3).view(np.int64))
                    yield p["hash"], found.tolist(), bitmap(found), None, None, None, None, None, None
                else:
                    starts = np.arange(a, b - PASSAGE + 1)
                    yield None, None, None, doc, a, p["stretch"], p["n"], p["last"], hasher.runs(starts, starts + PASSAGE, 4).view(np.int64).tolist()

    # the same join at every size: texts move by document, once
    joined = _texts(df, key, text).join(by_doc.hint("merge"), "doc").select("doc", "t", "places")
    told = store(map_rows(joined, FETCHED, rows), "fetched")
    return told.select("hash", "set", "map", "doc", "at", _stretch(*map(F.col, ("stretch", "n", "last", "windows"))))


def line_members(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(band, hash, low, high) of the paragraphs in shared bands, and one place (hash, doc, start, n) of each."""
    banded = lines.select("hash", F.explode("bands").alias("band"))
    shared = store(banded.groupBy("band").agg(F.min("hash").alias("low"), F.max("hash").alias("high")).filter("low <> high"), "bands")
    members = store(_meet(banded, shared, "band").select("band", "hash", "low", "high").distinct(), "members")
    hashes = store(members.select("hash").distinct(), "hashes")
    first = _meet(lines, hashes, "hash").groupBy("hash").agg(F.min(F.struct("doc", "start", "n")).alias("place"))
    return members, first.select("hash", "place.*")


def near_groups(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Written table (hash, group) of all paragraphs that are similar to another; ``sets(hash, set, map)`` has their shingles."""
    # first every member against its band's two representatives
    pairs = members.select("hash", F.explode(F.array("low", "high")).alias("other")).filter("hash <> other")
    pairs = pairs.select(F.least("hash", "other").alias("a"), F.greatest("hash", "other").alias("b")).distinct()
    links = store(_verified(pairs, sets), "links")
    named = store(components(links), "named")
    # then members of different components against each other
    placed = members.join(named, F.col("hash") == F.col("node"), "left")
    placed = store(placed.select("band", "hash", F.coalesce("component", "hash").alias("component")), "placed")
    mixed = store(placed.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("band"), "mixed")
    maps = [F.col("map")[i].alias(f"m{i}") for i in range(MAP_BITS // 64)]
    each = store(_meet(placed, mixed, "band").join(sets.select("hash", *maps, "set"), "hash"), "each")
    one, two = (each.select(*(F.col(c).alias(c + side) for c in each.columns)) for side in "ab")
    apart = sum((F.bit_count(F.col(f"m{i}a").bitwiseXOR(F.col(f"m{i}b"))) for i in range(MAP_BITS // 64)), F.lit(0))
    # sets of similarity s differ in at most (1 - s) / (1 + s) of their sizes' sum
    able = apart * (1 + SIMILARITY) <= (1 - SIMILARITY) * (F.size("seta") + F.size("setb")) + 1e-9
    across = one.join(two, (F.col("banda") == F.col("bandb")) & (F.col("hasha") < F.col("hashb")) & (F.col("componenta") != F.col("componentb")) & able & _similar(F.col("seta"), F.col("setb")))
    links = links.union(across.select(F.col("hasha").alias("a"), F.col("hashb").alias("b")).distinct())
    named = store(components(links), "named")
    roots = named.select(F.col("component").alias("hash"), F.col("component").alias("group")).distinct()
    return store(named.select(F.col("node").alias("hash"), F.col("component").alias("group")).union(roots), "groups")


def paragraph_hits(lines: DataFrame, groups: DataFrame, seen: DataFrame) -> DataFrame:
    """Written table (doc, start, n, keeper_doc, keeper_start) of all paragraphs that stand in several documents, near copies included."""
    wanted = store(seen.join(groups, "hash", "full").select("hash", F.coalesce("group", "hash").alias("group")), "wanted")
    placed = store(_meet(lines.drop("bands"), wanted, "hash").select("doc", "start", "n", "group").distinct(), "placed")
    keepers = placed.groupBy("group").agg(F.min(F.struct("doc", "start")).alias("keeper"), F.max("doc").alias("last")).filter("keeper.doc <> last")
    keepers = store(keepers.select("group", F.col("keeper.doc").alias("keeper_doc"), F.col("keeper.start").alias("keeper_start")), "keepers")
    return store(_meet(placed, keepers, "group").drop("group"), "paragraphs")


def run_ends(found: DataFrame, seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stretches (doc, at, w) of all shared anchors, and one place of each different stretch of anchors that have several.

    In the first table, a stretch that is its anchor's only one has a further row, its first place, without windows.
    """
    anchors = store(_meet(found.filter("bands is null").drop("bands"), seen, "hash"), "anchors")
    each = store(anchors.groupBy("hash", "stretch", "n").agg(F.min(F.struct("doc", "start")).alias("place"), F.max("doc").alias("last")), "each")
    mixed = store(each.groupBy("hash").agg(F.min("stretch").alias("x"), F.max("stretch").alias("y")).filter("x <> y").select("hash", F.lit(True).alias("mixed")), "mixed")
    each = store(_meet(each, mixed, "hash", "left").select("place.*", "n", "stretch", "last", "mixed"), "stretches")
    none, at = F.lit(None), F.col("start").alias("at")
    every = anchors.select("doc", at, _stretch(F.col("stretch"), F.col("n"), none, none))
    alike = each.filter("mixed is null").select("doc", at, _stretch(F.col("stretch"), F.col("n"), F.col("last"), F.array()))
    return every.union(alike), each.filter("mixed").drop("mixed")


def passage_hits(windows: DataFrame) -> DataFrame:
    """Written table (doc, start, n, keeper_doc, keeper_start) of runs of PASSAGE words or more that stand in several documents.

    ``windows(doc, at, w)`` are the places of stretches, and again one place of each: with its windows, or with none if
    its first place keeps all of it.
    """
    every = windows.filter("w.windows is null").select("doc", "at", "w.stretch")
    alike = windows.filter("size(w.windows) = 0 and doc <> w.last").select("w.stretch", F.col("doc").alias("keeper_doc"), F.col("at").alias("way"), F.lit(0).alias("low"), F.col("w.n").alias("high"))
    told = windows.filter("size(w.windows) > 0").select("doc", "at", "w.stretch", "w.last", F.posexplode("w.windows").alias("off", "window"))
    kept = told.groupBy("window").agg(F.min(F.struct("doc", (F.col("at") + F.col("off")).alias("at"))).alias("keeper"), F.max("last").alias("last")).filter("keeper.doc <> last")
    kept = store(kept.select("window", F.col("keeper.doc").alias("keeper_doc"), F.col("keeper.at").alias("keeper_start")), "kept")
    # from its first to its last window of one keeper at one distance, a stretch is the keeper's text
    way = (F.col("keeper_start") - F.col("off")).alias("way")
    parts = _meet(told.select("stretch", "off", "window"), kept, "window").groupBy("stretch", "keeper_doc", way).agg(F.min("off").alias("low"), (F.max("off") + PASSAGE).alias("high"))
    runs = store(alike.union(parts), "runs")
    hits = _meet(every, runs, "stretch").select("doc", (F.col("at") + F.col("low")).alias("start"), (F.col("at") + F.col("high")).alias("end"), "keeper_doc", (F.col("way") - F.col("at")).alias("way"))
    # runs that overlap or touch, of one keeper and at one distance from it, are one passage
    along = Window.partitionBy("doc", "keeper_doc", "way").orderBy("start")
    before = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    starts = hits.withColumn("new", F.coalesce(F.col("start") > before, F.lit(True)).cast("int"))
    numbered = starts.withColumn("passage", F.sum("new").over(along))
    whole = numbered.groupBy("doc", "keeper_doc", "way", "passage").agg(F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("n"))
    return store(whole.select("doc", "start", "n", "keeper_doc", (F.col("start") + F.col("way")).alias("keeper_start")), "passages")


def hits(df: DataFrame, key: str, text: str, found: DataFrame, seen: DataFrame) -> DataFrame:
    """(doc, start, n, keeper_doc, keeper_start) of all repeated paragraphs and passages; ``found`` are the units, ``seen`` their repeated hashes."""
    lines = found.filter("bands is not null").select("doc", "start", "n", "hash", "bands")
    members, wanted = line_members(lines)
    known, ends = run_ends(found, seen)
    told = fetched(df, key, text, wanted, ends)
    sets = store(told.filter("hash is not null").select("hash", "set", "map").dropDuplicates(["hash"]), "sets")
    paragraphs = paragraph_hits(lines, near_groups(members, sets), seen)
    return paragraphs.unionByName(passage_hits(known.union(told.filter("doc is not null").select("doc", "at", "w"))))


CLASSES = "{key} long, class_doc long, n_links long, links array<struct<keeper_doc:long,keeper_start:int>>, n_removed long, removed array<struct<a:int,b:int>>, n_short long, short_links array<struct<keeper_doc:long,keeper_start:int>>, short array<struct<a:int,b:int>>"


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    merged: list[dict] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1]["b"]:
            merged[-1]["b"] = max(merged[-1]["b"], b)
        else:
            merged.append({"a": a, "b": b})
    return merged


def _row(doc: int, units_: list) -> tuple:
    """(links, words removed, removals, short paragraphs, their links and places) of a document's units."""
    links, spans, short_links, short = set(), [], set(), []
    for u in units_:
        keeper, span = (u["keeper_doc"], u["keeper_start"]), (u["start"], u["start"] + u["n"])
        if u["n"] < PASSAGE:
            short_links.add(keeper)
            short.append(span)
        else:
            links.add(keeper)
            if keeper != (doc, u["start"]):
                spans.append(span)
    said = lambda found: [{"keeper_doc": d, "keeper_start": s} for d, s in sorted(found)]
    removed = _merged(spans)
    return said(links), sum(x["b"] - x["a"] for x in removed), removed, len(short), said(short_links), _merged(short)


def classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row for every document with its class and all its links: see CLASSES.

    ``class_doc`` is the smallest document reachable over shared paragraphs and passages of PASSAGE words or more,
    itself where it shares none; ``links`` are the places of all keepers of its repeated units, one for each
    passage; ``removed`` are the half-open word ranges to remove, merged, where another document, or an earlier
    place of this one, keeps the text.  ``short_links`` and ``short`` tell of repeated paragraphs of fewer words.
    """
    found = units(df, key, text)
    seen = store(found.groupBy("hash").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).filter("a <> b").select("hash"), "seen")
    both = hits(df, key, text, found, seen)
    edges = both.filter(f"doc <> keeper_doc and n >= {PASSAGE}").select(F.col("keeper_doc").alias("a"), F.col("doc").alias("b")).distinct()
    by_node = components(edges)
    per_doc = both.groupBy("doc").agg(F.collect_list(F.struct("start", "n", "keeper_doc", "keeper_start")).alias("units"))
    every = df.select(F.col(key).cast("long").alias("doc")).filter("doc is not null").distinct()
    joined = every.join(per_doc, "doc", "left").join(by_node, F.col("doc") == F.col("node"), "left").select("doc", F.coalesce("component", "doc").alias("class_doc"), "units")

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for doc, class_doc, units_ in source:
            links, n_removed, removed, n_short, short_links, short = _row(doc, units_ or [])
            yield doc, class_doc, len(links), links, n_removed, removed, n_short, short_links, short

    return map_rows(joined, CLASSES.format(key=key), rows)


def repeated(df: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``classes`` with paragraphs or passages that stand in other documents too."""
    return classes(df, key, text).filter("n_links > 0")
