"""Secret scans with corpus-wide ownership.

A scan finds candidate secrets in every text: assignments to secret-like names, access keys, long hex
runs, and free-standing random-looking tokens.  The hash of every candidate's value is then aggregated
over the whole corpus by distinct repositories and distinct owners.  A value that many owners share, or
several owners in many repositories, is a copied example; one that stays with one owner, or with few in few
repositories, looks live.  Random-looking tokens become findings only where their ownership says that they
are live; the other kinds are always findings.

Defined cases: a null text is empty; a null owner or repository counts as one owner or repository of its
own, other than an empty name; a repository under two owners is one repository; repeated rows are separate
rows with equal results; input columns other than the four named ones are ignored; an empty table gives an
empty table; very long texts are scanned whole in linear time.  Spans are half-open in code points.

At scale: texts are read once and never shuffled.  What moves are candidate hashes, aggregated first by
(hash, owner, repository) in each task.  The verdict table is joined as a plain equi-join of two written
tables, which adaptive execution splits where one hash holds many rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from math import log2

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import map_rows, small, store

# The base patterns, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "live")

#: Random-looking tokens: at least so long, with all three character classes, and so many bits a character.
FREE = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[a-z+/_-]*[A-Z0-9])[A-Za-z0-9+/_-]{20,}={0,2}")
MIN_BITS = 3.5
#: A value of more owners than this is a copied example, and so is one of several owners in more repositories than this.
MAX_OWNERS = 2
MAX_REPOS = 20


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * log2(c / n) for c in Counter(value).values())


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the base kinds, by start and then by kind as listed."""
    found = [(m.start(), m.end(), "assign", m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), m.end(), "access", m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex", m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def free_spans(text: str, taken: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """Random-looking tokens that overlap no base span."""
    out = []
    starts, ends = sorted(x[0] for x in taken), sorted(x[1] for x in taken)
    opened = closed = 0
    for m in FREE.finditer(text):
        v = m[0]
        while opened < len(starts) and starts[opened] < m.end():
            opened += 1
        while closed < len(ends) and ends[closed] <= m.start():
            closed += 1
        if opened > closed:  # some span begins before this token's end and has not ended at its start
            continue
        if re.search("[a-z]", v) and re.search("[A-Z]", v) and re.search("[0-9]", v) and entropy(v) >= MIN_BITS:
            out.append((m.start(), m.end(), "live", v))
    return out


def render(spans: list[tuple]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind, *_ in spans)


def scan(df: DataFrame, key: str, text: str, repo: str, owner: str) -> DataFrame:
    """Written table (rid, k, repo, owner, base, candidates) of every row; rid numbers the rows."""

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        rid = TaskContext.get().partitionId() << 33
        for k, t, r, o in source:
            base = base_spans(t or "")
            free = free_spans(t or "", base)
            digest = lambda v: hashlib.blake2b(v.encode(), digest_size=16).digest()
            yield rid, k, r, o, [{"a": a, "b": b, "kind": kind, "hash": digest(v)} for a, b, kind, v in base + free]
            rid += 1

    picked = df.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(repo).cast("string").alias("r"), F.col(owner).cast("string").alias("o"))
    kind = picked.schema["k"].dataType.simpleString()
    return store(map_rows(picked, f"rid long, k {kind}, repo string, owner string, candidates array<struct<a:int,b:int,kind:string,hash:binary>>", rows), "secrets")


def ownership(found: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """Written table (hash, n_repos, n_owners, n_rows, live) of every candidate value in the corpus."""
    one = found.select(F.explode("candidates.hash").alias("hash"), "repo", "owner")
    # partial sums before every exchange: a value with a third of all rows is never gathered
    places = store(one.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n")), "places")
    owners = places.groupBy("hash", "owner").agg(F.sum("n").alias("n")).groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_rows"))
    repos = places.groupBy("hash", "repo").agg(F.lit(1).alias("one")).groupBy("hash").agg(F.count("*").alias("n_repos"))
    live = (F.col("n_owners") == 1) | (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)
    return store(owners.join(repos, "hash").select("hash", "n_repos", "n_owners", "n_rows", live.alias("live")), "owners")


def find_secrets(df: DataFrame, key: str, text: str, repo: str, owner: str, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """One row per input row: (key, findings, n_live, n_examples).

    ``findings`` is an array of (a, b, kind, live, n_repos, n_owners) by start and kind; free-standing tokens are in
    it only if live.
    """
    found = scan(df, key, text, repo, owner)
    verdict = ownership(found, max_owners, max_repos).select("hash", "live", "n_repos", "n_owners")
    each = found.filter(F.size("candidates") > 0).select("rid", F.explode("candidates").alias("c")).select("rid", "c.*")
    judged = each.join(F.broadcast(verdict) if small(verdict) else verdict, "hash").filter("kind <> 'live' or live")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    per_row = judged.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("a", order.alias("o"), "b", "kind", "live", "n_repos", "n_owners"))).alias("s"))
    findings = F.transform("s", lambda x: F.struct(*(x[c].alias(c) for c in ("a", "b", "kind", "live", "n_repos", "n_owners"))))
    empty = F.array().cast("array<struct<a:int,b:int,kind:string,live:boolean,n_repos:bigint,n_owners:bigint>>")
    out = found.select("rid", "k").join(per_row.select("rid", findings.alias("findings")), "rid", "left").withColumn("findings", F.coalesce("findings", empty))
    return out.select(F.col("k").alias(key), "findings", F.size(F.filter("findings", lambda x: x["live"])).cast("long").alias("n_live"), F.size(F.filter("findings", lambda x: ~x["live"])).cast("long").alias("n_examples"))


def mask(text: str, spans: list[dict], sign: str = "[SECRET]") -> str:
    """``text`` with the given spans, in order of their starts, replaced; overlapping spans are masked once."""
    out, at = [], 0
    for s in spans:
        if s["a"] >= at:
            out += [text[at : s["a"]], sign]
        at = max(at, s["b"])
    return "".join(out) + text[at:]
