"""Toxicity scores of deobfuscated text.

A noisy channel stands between what was meant and what was written: letters become look-alike signs, are
repeated, or words are spaced out or cut.  Every written sign gives steps of a lattice: the letters that it may
stand for, nothing for a repetition, and for a blank or mark between letters either nothing or the blank
between two words.  Viterbi decoding under a character trigram model of the corpus picks the likeliest
path.  In plain words blanks are the only choice, and with two letters on each side it is one that other blanks
have no part in, so it is made pair by pair.  The score comes from the words of the restored text: each word and
word start carries its share of toxic texts, learned from labelled rows, and a logistic regression weighs the
strongest of them.

Defined cases: a null or wordless text gets the score of a text without evidence; labels other than 0
and 1 are not learned from; a key that is labelled twice counts by its larger label; without labelled
rows of both kinds every score is the prior; repeated rows get equal scores; clashing columns are ignored; an
empty table gives an empty table.  Texts are read whole and words of any length are decoded, in linear time; a
word of more than PIECE signs is decoded piece by piece, each from where the best path of the last ended.

At scale: the trigram model counts the whole corpus, task by task, into a fixed number of cells.  The
lexicon and the regression are fitted on at most SAMPLE labelled rows, chosen by a hash of their keys;
what executors get is bounded by LEXICON.  Scoring is one scan without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby
from math import log
from operator import add

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import map_rows, store
from inkmill.llm.langmix import held_out

#: Labelled rows that the classifier is fitted on, at most.
SAMPLE = 40_000
#: Words and word starts that it keeps, those with most evidence, at most.
LEXICON = 100_000
#: Rows of prior evidence that a word's share is smoothed with.
PRIOR_ROWS = 4.0
#: A word or word start is kept if so many toxic rows hold it, and toxic rows twice as often as others.
MIN_TOXIC = 3
#: The regression reads the shares of so many words, the strongest, and how many others are strong.
TOP_WORDS = 3
THRESHOLD = 0.3
STARTS = (4, 6)
#: Letters a-z, the blank between words, and any other letter.
CLASSES = 28
BLANK, OTHER = 26, 27
#: Entries after which a memo starts anew, and the longest token that is remembered.
MEMO = 1 << 18
MEMO_SIGNS = 64
#: Signs after which the best path so far is settled.
PIECE = 1 << 16

# Signs that stand for letters.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¥": "y"}
#: Log probabilities of the channel: a letter, a sign for a letter, a sign that is none, a repetition, and a blank or
#: mark within a word.
PLAIN, SIGN, LITERAL, EXTRA, DROP = 0.0, -1.0, -6.0, -1.5, -4.0

WORD = re.compile(r"[^\W\d_]+")
_SIGNS = re.escape("".join(LEET))
#: Signs among letters.
MIXED = re.compile(rf"(?<![^\W_])(?<![{_SIGNS}])(?=[{_SIGNS}]*[^\W\d_])(?=[^\W\d_]*[{_SIGNS}])[{_SIGNS}\w*.\-]*[^\W_]")
RUN = re.compile(r"\w+")
TRIPLE = re.compile(r"([^\W\d_])\1\1")
#: Four or more single letters or signs with marks between.
DOTTED = re.compile(rf"(?<![\w{_SIGNS}])[^\W_](?:[.\-_*]{{1,2}}[^\W_]|[.\-_*]{{1,2}}[{_SIGNS}]){{3,}}(?!\w)")
#: Letters cut by marks.
CUT = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:[.\-_*]++[^\W\d_]++)++")
#: Single characters that may be letters of a spaced-out word.
SINGLE = re.compile(rf"[^\W_]|[{_SIGNS}]")
SPACED = 4
#: Marks around a word that are no signs for letters there.
MARKS = ".,;:!?\"'()[]{}*#%&"


def _classes(text: str) -> np.ndarray:
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    out = np.full(len(c), CLASSES - 1, np.int64)
    out[(c >= 97) & (c <= 122)] = c[(c >= 97) & (c <= 122)] - 97
    out[c < 97] = 26
    out[(c > 122) & (c < 0xC0)] = 26
    return out


def _class(ch: str) -> int:
    return ord(ch) - 97 if "a" <= ch <= "z" else OTHER


def _written(path: tuple | None) -> str:
    out = []
    while path:
        path, ch = path
        out.append(ch)
    return "".join(reversed(out))


class _Noise(dict):
    """Decisions on blanks by the signs around them, made on demand."""

    def __init__(self, channel: Channel):
        super().__init__()
        self.channel = channel

    def __missing__(self, ends: str) -> bool:
        if len(self) >= MEMO:
            self.clear()
        self[ends] = found = self.channel._is_noise(ends)
        return found

    def __reduce__(self):
        return _Noise, (self.channel,)


class Channel:
    """Character model and decoder."""

    def __init__(self, counts: np.ndarray):
        cube = counts.reshape(CLASSES, CLASSES, CLASSES) + 0.05
        self.logp = np.log(cube / cube.sum(2, keepdims=True)).tolist()
        self.memo: dict[tuple[str, float], str] = {}
        self.steps_of: dict[tuple[str, float], list[tuple[str, int, float]]] = {}
        self.noise = _Noise(self)

    def steps(self, sign: str, drop: float) -> list[tuple[str, int, float]]:
        """(what is written, its class or -1 for nothing, log probability) of every step that reads ``sign``."""
        found = self.steps_of.get((sign, drop))
        if found is None:
            if len(self.steps_of) >= MEMO:
                self.steps_of.clear()
            if sign.isalpha():
                found = [(sign, _class(sign), PLAIN)]
            elif sign in LEET:
                found = [(ch, _class(ch), SIGN) for ch in LEET[sign]] + [(" ", BLANK, LITERAL)]
            else:
                found = [("", -1, drop), (" ", BLANK, PLAIN)]
            self.steps_of[sign, drop] = found
        return found

    def best(self, signs: str, drop: float = DROP) -> tuple[float, str]:
        """Log probability and text of the likeliest path through the lattice of ``signs``, which are in lower case."""
        # a state is the last two classes; it holds its path as (path before, sign written)
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(BLANK, BLANK): (0.0, None)}
        settled: list[str] = []
        before = ""
        for i, sign in enumerate(signs):
            steps = self.steps(sign, drop)
            again = sign == before and steps[0][1] >= 0
            new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, path) in states.items():
                row = self.logp[a][b]
                if again and ((a, b) not in new or score + EXTRA > new[a, b][0]):
                    new[a, b] = score + EXTRA, path
                for ch, kind, cost in steps:
                    if kind < 0 or kind == b == BLANK:
                        state, value, held = (a, b), score + cost, path
                    else:
                        state, value, held = (b, kind), score + cost + row[kind], (path, ch)
                    if state not in new or value > new[state][0]:
                        new[state] = value, held
            states, before = new, sign
            if i % PIECE == PIECE - 1:
                state, (score, path) = max(states.items(), key=lambda x: x[1][0])
                settled.append(_written(path))
                states = {state: (score, None)}
        score, path = max(((score if b == BLANK else score + self.logp[a][b][BLANK], path) for (a, b), (score, path) in states.items()), key=lambda x: x[0])
        return score, "".join([*settled, _written(path)]).strip()

    def decode(self, signs: str, drop: float = DROP) -> str:
        """The likeliest text behind ``signs``."""
        known = self.memo.get((signs, drop))
        if known is None:
            known = self.best(signs, drop)[1]
            if len(signs) <= MEMO_SIGNS:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[signs, drop] = known
        return known

    def _is_noise(self, ends: str) -> bool:
        """Is a blank likelier noise than a word's end?  ``ends``: two signs before it, a blank for lack of one, and up to two behind."""
        x, y = ends[:2].lstrip(), ends[2:]
        if not (x.isalpha() and y.isalpha()):
            return False
        a, b = [_class(c) for c in x] if len(x) == 2 else (BLANK, _class(x))
        c, d = [_class(c) for c in y] if len(y) == 2 else (_class(y), BLANK)
        logp = self.logp
        return logp[a][b][c] + logp[b][c][d] + DROP > logp[a][b][BLANK] + logp[b][BLANK][c] + logp[BLANK][c][d]

    def joined(self, tokens: list[str]) -> Iterator[str]:
        """Words that a blank has cut; tokens of one letter each are for ``spaced``."""
        ends = map(add, [(" " + t)[-2:] for t in tokens], [t[:2] for t in tokens[1:]])
        held, last = "", -1
        for i in [i for i, noise in enumerate(map(self.noise.__getitem__, ends)) if noise]:
            if len(tokens[i]) + len(tokens[i + 1]) > 2:
                if held and i != last:
                    yield from WORD.findall(held)
                    held = ""
                held = (held or tokens[i]) + tokens[i + 1]
                last = i + 1
        yield from WORD.findall(held)

    def words_of_token(self, token: str) -> set[str]:
        """The words of a token without white space, as written and as meant; the token is in lower case."""
        core = token.strip(MARKS)
        plain = core.isalpha()  # then it can only be disguised by repetition
        found = {core} if plain else set(WORD.findall(token))
        if TRIPLE.search(token):
            found.update(w for run in RUN.findall(token) if TRIPLE.search(run) for w in WORD.findall(self.decode(run)))
        for pattern in () if plain else (MIXED, DOTTED, CUT):
            found.update(w for m in pattern.finditer(token) for w in self.decode(m[0], 0.0 if pattern is DOTTED else DROP).split())
        return found

    def spaced(self, tokens: list[str]) -> Iterator[str]:
        """Words spelled out in tokens of one character each."""
        run: list[str] = []
        last = -2
        for i in [i for i, t in enumerate(tokens) if len(t) == 1]:
            if i != last + 1:
                yield from self._spelled(run)
                run = []
            run.append(tokens[i])
            last = i
        yield from self._spelled(run)

    def _spelled(self, run: list[str]) -> Iterator[str]:
        for fits, part in groupby(run, lambda t: bool(SINGLE.fullmatch(t))):
            letters = list(part)
            if fits and len(letters) >= SPACED:
                yield from self.decode(" ".join(letters), 0.0).split()

    def restored(self, text: str) -> set[str]:
        """Words that decoding adds to those that are written plainly."""
        return words_of(text, self) - set(WORD.findall(text.lower()))


def train_channel(df: DataFrame, text: str) -> Channel:
    """Trigram counts over every text of ``df``."""

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        total = np.zeros(CLASSES**3, np.int64)
        for (t,) in source:
            for at in range(0, len(t), 1 << 20):
                c = _classes(f" {t[at : at + (1 << 20)]} ")
                total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES**3)
        for cell in np.flatnonzero(total).tolist():
            yield cell, int(total[cell])

    cells = map_rows(df.select(text).filter(F.col(text).isNotNull()), "cell int, n long", rows).groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.zeros(CLASSES**3)
    for r in cells.collect():  # CLASSES ** 3 rows at most
        counts[r["cell"]] = r["n"]
    return Channel(counts)


def words_of(text: str | None, channel: Channel) -> set[str]:
    tokens = (text or "").lower().split()
    return {w for t in set(tokens) for w in channel.words_of_token(t)}.union(channel.spaced(tokens), channel.joined(tokens))


def features(word: str) -> list[str]:
    return [word, *(f"^{word[:n]}" for n in STARTS if len(word) > n)]


#: What most tokens tell.
NOTHING: dict[str, float] = {}


class Scorer:
    """Lexicon and regression."""

    def __init__(self, channel: Channel, lexicon: dict[str, tuple[int, int]], toxic: int, clean: int):
        self.channel, self.lexicon = channel, lexicon
        self.prior = (toxic + 0.5) / (toxic + clean + 1)
        self.weights: np.ndarray | None = None
        self.known: dict[str, dict[str, float]] = {}

    def _share(self, feature: str, label: int | None = None) -> float:
        p, n = self.lexicon.get(feature, (0, 0))
        if label is not None:  # a text that was learned from must not vouch for itself
            p, n = (p - 1, n) if label and p else (p, n - 1) if not label and n else (p, n)
        return (p + PRIOR_ROWS * self.prior) / (p + n + PRIOR_ROWS)

    def _shares(self, words: Iterable[str], label: int | None = None) -> dict[str, float]:
        """The words' shares of toxic texts, where above the prior."""
        found = {}
        for w in words:
            listed = [f for f in features(w) if f in self.lexicon]
            if listed and (share := max(self._share(f, label) for f in listed)) > self.prior:
                found[w] = share
        return found

    def vector(self, words: Iterable[str], label: int) -> np.ndarray:
        """Of the words of a row with this label, which was learned from."""
        return self._vector(self._shares(words, label))

    def _vector(self, shares: dict[str, float]) -> np.ndarray:
        best = sorted(shares.values(), reverse=True)
        top = [log(s / (1 - s)) for s in (*best[:TOP_WORDS], *[self.prior] * TOP_WORDS)[:TOP_WORDS]]
        return np.array([1.0, *top, log(1 + sum(s > 0.8 for s in best))])

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return self.prior
        tokens = (text or "").lower().split()
        shares = self._shares({*self.channel.spaced(tokens), *self.channel.joined(tokens)})
        for t in set(tokens):
            known = self.known.get(t)
            if known is None:
                known = self._shares(self.channel.words_of_token(t)) or NOTHING
                if len(t) <= MEMO_SIGNS:
                    if len(self.known) >= MEMO:
                        self.known.clear()
                    self.known[t] = known
            if known:
                shares.update(known)
        z = float(self._vector(shares) @ self.weights)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, key: str, text: str, labels: DataFrame, label_key: str, label: str, sample: int = SAMPLE) -> Scorer:
    """Fit on labelled rows that are not held out; the trigram model is of all of ``docs``."""
    spark = docs.sparkSession
    channel = train_channel(docs, text)
    usable = labels.select(F.col(label_key).alias("k"), F.col(label).cast("int").alias("y")).filter(F.col("k").isNotNull() & F.col("y").isin(0, 1)).filter(~held_out("k"))
    chosen = usable.groupBy("k").agg(F.max("y").alias("y")).orderBy(F.xxhash64("k"), "k").limit(sample)
    # at most ``sample`` rows of (key, label)
    labelled = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(chosen), "k").select("t", "y")
    held = spark.sparkContext.broadcast(channel)

    def worded(source: Iterator[tuple]) -> Iterator[tuple]:
        for t, y in source:
            yield sorted(words_of(t, held.value)), y

    rows_of = store(map_rows(labelled, "words array<string>, y int", worded), "labelled")

    def counted(source: Iterator[tuple]) -> Iterator[tuple]:
        toxic: Counter[str] = Counter()
        clean: Counter[str] = Counter()

        def flushed() -> Iterator[tuple]:
            for f in toxic.keys() | clean.keys():
                yield f, toxic[f], clean[f]
            toxic.clear()
            clean.clear()

        for words, y in source:
            (toxic if y else clean).update({f for w in words for f in features(w)})
            if len(toxic) + len(clean) > 500_000:
                yield from flushed()
        yield from flushed()

    sums = map_rows(rows_of, "feature string, p long, n long", counted).groupBy("feature").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    totals = {r["y"]: r["count"] for r in rows_of.groupBy("y").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    useful = sums.filter((F.col("p") >= MIN_TOXIC) & (F.col("p") * (toxic + clean) > (F.col("p") + F.col("n")) * 2 * toxic)).orderBy(F.desc(F.col("p") / (F.col("n") + 1)), "feature").limit(LEXICON)
    lexicon = {r["feature"]: (r["p"], r["n"]) for r in useful.collect()}
    scorer = Scorer(channel, lexicon, toxic, clean)
    if toxic and clean:
        shared = spark.sparkContext.broadcast(scorer)

        def vectors(source: Iterator[tuple]) -> Iterator[tuple]:
            for words, y in source:
                yield shared.value.vector(words, y).tolist(), y

        got = map_rows(rows_of, "x array<double>, y int", vectors).collect()  # ``sample`` rows of five numbers
        scorer.weights = _fit(np.array([r["x"] for r in got]), np.array([r["y"] for r in got], float))
    return scorer


def predict(docs: DataFrame, key: str, text: str, scorer: Scorer) -> DataFrame:
    """(key, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        s = shared.value
        for k, t in source:
            yield k, s.score(t)

    picked = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return map_rows(picked, f"{key} {picked.schema['k'].dataType.simpleString()}, score double", rows)
