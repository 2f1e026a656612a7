"""Language identification as mixture inference.

Every language has a distribution over hashed character trigrams, learned from labelled texts.  A
document's language proportions are estimated by expectation-maximisation over its trigrams.  The set of
languages grows from the best single one, and a further language stays only where it raises the
likelihood by more than a penalty that grows with the document's length.

Defined cases: a null text, or one without a letter (numerals such as ² or ½ are none), is ``und`` with score
0; null labels are not learned from; ties go to the language that sorts first; repeated rows count as often as
they occur; very long texts are read whole, in chunks; other input columns are ignored; without any learned
language, as with an empty table, every document is ``und``; beyond MAX_LANGUAGES labels those with most text are
learned.

At scale: training reads the corpus once; tasks sum their counts, so what is shuffled and gathered is at
most BUCKETS cells a language and task.  Prediction is one scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import bound_batches, map_rows, release_memory

BUCKETS = 1 << 15
ALPHA = 0.1
#: Languages of a model, at most: its size is bounded by them.
MAX_LANGUAGES = 512
ROUNDS = 12
#: Weight of the penalty: a further language must gain so many times ln(trigrams) / 2.
PENALTY = 2.0
#: Characters whose trigrams are hashed at once; memory stays bounded on very long texts.
CHUNK = 1 << 20

_M1, _M2, _M3 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)
_SHIFT = np.uint32(32 - BUCKETS.bit_length() + 1)


@lru_cache(1)
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(text: str) -> np.ndarray:
    """How often each bucket occurs among the trigrams of letters, with one blank for all that stands between words."""
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(text), CHUNK):
        c = np.frombuffer(f" {text[at : at + CHUNK + 2].lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
        word = _letters()[c]
        if word.any():
            c = np.where(word, c, np.uint32(32))[word | np.append(True, word[:-1])]
            counts += np.bincount((c[:-2] * _M1 ^ c[1:-1] * _M2 ^ c[2:] * _M3) * _M1 >> _SHIFT, minlength=BUCKETS)
    return counts


class Mixture:
    """The learned languages with log-likelihoods of all buckets."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        smooth = counts + ALPHA
        self.p = smooth / smooth.sum(1, keepdims=True)
        self.logp = np.log(self.p)

    def _em(self, p: np.ndarray, n: np.ndarray, total: int, rounds: int) -> tuple[np.ndarray, float]:
        share = np.full(len(p), 1 / len(p))
        for _ in range(rounds):
            joint = share[:, None] * p
            mix = joint.sum(0)
            new = (joint / mix) @ n / total
            moved = np.abs(new - share).max()
            share = new
            if moved < 1e-3:
                break
        return share, float(np.log(share @ p) @ n)

    def infer(self, text: str | None) -> list[tuple[str, float]]:
        """The selected languages with their proportions, the largest first; empty if undetermined."""
        if not text or not self.names:
            return []
        counts = trigrams(text)
        seen = np.flatnonzero(counts)
        if not len(seen):
            return []
        n = counts[seen].astype(float)
        total = n.sum()
        single = self.logp[:, seen] @ n
        best = int(single.argmax())
        chosen, share, likelihood = [best], np.ones(1), float(single[best])
        if len(self.names) > 1:
            p = self.p[:, seen]
            full, _ = self._em(p, n, total, ROUNDS)
            cost = PENALTY * np.log(total + 1) / 2
            for other in np.argsort(-full, kind="stable"):
                if other in chosen:
                    continue
                wider = [*chosen, int(other)]
                new, gained = self._em(p[wider], n, total, ROUNDS)
                if gained - likelihood <= cost:
                    continue
                chosen, share, likelihood = wider, new, gained
        order = sorted(range(len(chosen)), key=lambda i: (-share[i], self.names[chosen[i]]))
        return [(self.names[chosen[i]], float(share[i])) for i in order]


def train(df: DataFrame, text: str, lang: str) -> Mixture:
    """Learn from all rows of ``df`` with text and label."""

    def cells_of(sums: dict[str, np.ndarray]) -> Iterator[tuple]:
        for name, counts in sums.items():
            for b in np.flatnonzero(counts).tolist():
                yield name, b, int(counts[b])

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        sums: dict[str, np.ndarray] = {}
        for t, name in source:
            if name not in sums and len(sums) >= MAX_LANGUAGES:
                yield from cells_of(sums)
                sums.clear()
            if name not in sums:
                sums[name] = np.zeros(BUCKETS, np.int64)
            sums[name] += trigrams(t)
        yield from cells_of(sums)

    labelled = df.select(text, lang).filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    cells = map_rows(labelled, "lang string, bucket int, n long", rows).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    by_lang = cells.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("cells"), F.sum("n").alias("total"))
    got = by_lang.orderBy(F.desc("total"), "lang").limit(MAX_LANGUAGES).select("lang", "cells").collect()
    got.sort(key=lambda r: r["lang"])
    counts = np.zeros((len(got), BUCKETS))
    for i, r in enumerate(got):
        cell = np.array(r["cells"], np.int64)
        counts[i, cell[:, 0]] = cell[:, 1]
    return Mixture([r["lang"] for r in got], counts)


def held_out(key: str):
    """The fold that nothing is learned from: crc32 of the key as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def predict(df: DataFrame, key: str, text: str, model: Mixture) -> DataFrame:
    """(key, lang_pred, score, languages): score is the share of the predicted language."""
    held = df.sparkSession.sparkContext.broadcast(model)

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        m = held.value
        for k, t in source:
            found = m.infer(t)
            name, score = found[0] if found else ("und", 0.0)
            yield k, name, min(1.0, score), [{"lang": a, "share": b} for a, b in found]

    picked = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = picked.schema["k"].dataType.simpleString()
    return map_rows(picked, f"{key} {kind}, lang_pred string, score double, languages array<struct<lang:string,share:double>>", rows)


def identify(df: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """Learn from the rows that are not held out, and predict every row of ``df``."""
    model = train(df.filter(~held_out(key)), text, lang)
    return predict(df, key, text, model)


def keep(df: DataFrame, text: str, model: Mixture, main_share: float) -> DataFrame:
    """The rows of ``df`` whose main language is known and has at least ``main_share`` of the text."""
    held = df.sparkSession.sparkContext.broadcast(model)
    place = df.columns.index(text)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = (held.value.infer(t.as_py()) for t in batch.column(place))
            yield batch.filter(pa.array([bool(f) and f[0][1] >= main_share for f in found], pa.bool_()))
        release_memory()

    bound_batches(df.sparkSession)
    return df.mapInArrow(run, df.schema)
