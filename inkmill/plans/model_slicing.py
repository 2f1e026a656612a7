"""Slicing with cut points from a chat model.

A book's next chunk starts behind the last cut of the one before, so books are the unit of parallel work:
each is read in the order of its lines, with its own providers.  Only the lines from the current chunk on are
held, and of a long chunk only its numbers: texts beyond ``IN_MEMORY`` characters go to a temporary file, and
the prompt is read from there.  Turn speculation off for such jobs, and name a
folder for ``answers`` that all executors reach: a retried task, or a later run, finds there what was answered.
"""

from __future__ import annotations

import hashlib
import json
import pickle
import tempfile
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator, MutableMapping
from dataclasses import asdict, dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.functions.text import count_chars, estimate_tokens
from inkmill.operators import cuts as C
from inkmill.operators.slicing import best_cut, chunk_end
from inkmill.plans.config import ProviderOptions, SliceOptions
from inkmill.plans.prompts import long_messages, messages, pieces_of
from inkmill.providers.answers import AnswerFolder
from inkmill.providers.base import ChatProvider, build

NO_CUTS = "LLM returned no valid cuts"
SLICES = "book_id string, slice_id long, start_line long, end_line long, char_len long, text string, title string, summary string, error string, provider string, model string"
#: Characters of a book's texts that are held in memory, and in a batch of its slices.
IN_MEMORY, OUT_AT_ONCE = 32_000_000, 4_000_000

Batch = tuple[list[str], np.ndarray, np.ndarray]  # texts, characters and tokens of lines


@dataclass
class Slice:
    slice_id: int
    start_line: int
    end_line: int
    char_len: int | None = None
    text: str | None = None
    title: str | None = None
    summary: str | None = None
    error: str | None = None
    provider: str | None = field(default=None)
    model: str | None = field(default=None)


class Asked:
    """What came of asking for the cuts of one chunk: provider and model of the last valid answer, and of the last failure."""

    def __init__(self):
        self.cuts: list[C.Cut] = []
        self.error: Exception | None = None
        self.used: tuple[str | None, str | None] = (None, None)
        self.failed: tuple[str | None, str | None] = (None, None)


def _key(name: str, model: str, prompt: list[dict]) -> str:
    """Digest of the request's JSON, which is never whole in memory."""
    text = lambda v: json.dumps(v, ensure_ascii=False)
    digest = hashlib.sha256(f"[{text(name)}, {text(model)}, [".encode())
    for i, message in enumerate(prompt):
        digest.update(f"{', ' if i else ''}{{".encode())
        for k, (field_, value) in enumerate(message.items()):
            digest.update(f'{", " if k else ""}{text(field_)}: "'.encode())
            for piece in pieces_of(value):
                digest.update(text(piece)[1:-1].encode())
            digest.update(b'"')
        digest.update(b"}")
    digest.update(b"]]")
    return digest.hexdigest()


def ask(prompt: list[dict], first: int, last: int, options: SliceOptions, clients: dict[str, tuple[ChatProvider, str]], answers: MutableMapping[str, str] | None = None, sleep: Callable[[float], None] = time.sleep) -> Asked:
    """Ask the providers in order, each up to retry_max times; a valid answer without cuts goes on to the next."""
    asked = Asked()
    wanted = {"type": options.response_format} if options.response_format else None
    for name, (client, model) in clients.items():
        key = _key(name, model, prompt) if answers is not None else ""
        for attempt in range(options.retry_max):
            try:
                content = answers.get(key) if answers is not None else None
                if content is None:
                    content = client.chat_completions(model=model, messages=prompt, max_tokens=options.completion_max_tokens, temperature=options.temperature, response_format=wanted, timeout_s=options.timeout_s).content
                asked.cuts = C.validate(C.parse(content), first, last)
                if answers is not None:
                    answers[key] = content
                asked.used, asked.error = (name, model), None
                break
            except Exception as e:  # noqa: BLE001  whatever fails is tried again
                asked.error, asked.failed = e, (name, model)
                if attempt < options.retry_max - 1:
                    sleep(options.retry_backoff_s * 2**attempt)
        if asked.cuts:
            break
    return asked


class _Held:
    """Lines of one book from ``first`` on, as far as they were needed; line numbers count from 0."""

    def __init__(self, batches: Iterable[Batch]):
        self.batches = iter(batches)
        self.first = self.end = 0
        self.ended = False
        self.total = self.packed = np.zeros(1, np.int64)  # prefix sums from the first line on
        self.blocks: deque[list] = deque()  # first line, number of lines, texts or None, place in the file
        self.in_memory, self.file, self.read = 0, None, (None, None)

    def fill(self, at: int, budget: int) -> bool:
        """Begin at line ``at``; read the lines that fit the budget and one more at least. Is there any?"""
        self.total, self.packed = self.total[at - self.first :], self.packed[at - self.first :]
        self.first = at
        while self.blocks and sum(self.blocks[0][:2]) <= at:
            gone = self.blocks.popleft()
            self.in_memory -= sum(map(len, gone[2] or ()))
        if self.file and not any(b[2] is None for b in self.blocks):
            self.file.close()
            self.file = None
        totals, packs = [self.total], [self.packed]
        while not self.ended and (self.end - at < 2 or packs[-1][-1] - packs[0][0] <= budget):
            if (batch := next(self.batches, None)) is None:
                self.ended = True
            elif batch[0]:
                texts, chars, tokens = batch
                totals.append(totals[-1][-1] + np.cumsum(chars, dtype=np.int64))
                packs.append(packs[-1][-1] + np.cumsum(tokens + 1, dtype=np.int64))
                self._hold(texts)
        self.total, self.packed = np.concatenate(totals), np.concatenate(packs)
        return at < self.end

    def _hold(self, texts: list[str]) -> None:
        self.blocks.append([self.end, len(texts), texts, None])
        self.end += len(texts)
        self.in_memory += sum(map(len, texts))
        if self.in_memory > IN_MEMORY:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(0, 2)
            for block in self.blocks:
                if block[2] is not None:
                    block[3], _ = self.file.tell(), pickle.dump(block[2], self.file)
                    block[2] = None
            self.in_memory = 0

    def texts(self, a: int, b: int) -> Iterator[list[str]]:
        """The texts of lines a to b - 1, block by block."""
        for first, n, texts, place in self.blocks:
            if first < b and a < first + n:
                if texts is None:
                    if self.read[0] != first:
                        self.file.seek(place)
                        self.read = first, pickle.load(self.file)
                    texts = self.read[1]
                yield texts[max(a - first, 0) : b - first]
            elif first >= b:
                break

    def in_file(self) -> bool:
        return self.file is not None


def slice_lines(batches: Iterable[Batch], options: SliceOptions, clients: dict[str, tuple[ChatProvider, str]], max_slices: int | None = None, **asking) -> Iterator[Slice]:
    """Slices of one book's lines as they are decided; an error ends the book with a slice that tells it."""
    held = _Held(batches)
    at, number = 0, 1
    low, high = options.target_chars_min, options.target_chars_max

    def made(end: int, cut: C.Cut | None, used: tuple) -> Slice:
        text = "\n".join(t for texts in held.texts(at, end) for t in texts)
        return Slice(number, at + 1, end, int(total[end - base] - total[at - base]), text, cut and cut.title, cut and cut.summary, None, *used)

    while (max_slices is None or number <= max_slices) and held.fill(at, options.chunk_input_tokens):
        base, total = at, held.total
        stop = at + chunk_end(held.packed, 0, options.chunk_input_tokens)
        if held.in_file():
            prompt = long_messages(at + 1, lambda a=at, b=stop: held.texts(a, b), low, high)
        else:
            prompt = messages(at + 1, ((n, t) for n, t in enumerate((t for texts in held.texts(at, stop) for t in texts), at + 1)), low, high)
        asked = ask(prompt, at + 1, stop, options, clients, **asking)
        if not asked.cuts:
            if asked.error is None and held.ended and stop == held.end:
                yield made(stop, None, asked.used)  # the rest of the book is its last slice
            else:
                yield Slice(number, at + 1, stop, error=NO_CUTS if asked.error is None else str(asked.error), provider=asked.failed[0], model=asked.failed[1])
            return
        by_end = {c.end_line: c for c in asked.cuts}
        ends = np.array(sorted(by_end)) - base
        while (max_slices is None or number <= max_slices) and (end := best_cut(total, at - base, ends, options)) is not None:
            end += base
            yield made(end, by_end[end], asked.used)
            at, number = end, number + 1


def clients_of(providers: dict[str, ProviderOptions], options: SliceOptions, make: Callable[[ProviderOptions], ChatProvider] = build) -> dict[str, tuple[ChatProvider, str]]:
    """Providers in the configured order; unknown names and an empty order are errors."""
    unknown = [n for n in options.provider_order if n not in providers]
    if unknown:
        raise ValueError(f"provider_order names unknown providers: {', '.join(unknown)}")
    if not options.provider_order:
        raise ValueError("provider_order is empty")
    return {n: (make(providers[n]), providers[n].model) for n in dict.fromkeys(options.provider_order)}


def slice_books(lines: DataFrame, options: SliceOptions, providers: dict[str, ProviderOptions], make: Callable[[ProviderOptions], ChatProvider] = build, max_slices: int | None = None, answers: str | None = None) -> DataFrame:
    """SLICES of every book in ``lines(book_id, line_no, text)``; ``answers`` names the folder where answers are kept.

    ``line_no`` only orders the lines, whatever its type; ``chars`` and ``tokens`` are counted where they are not given.
    """
    if max_slices is not None and max_slices <= 0:
        raise ValueError("max_slices must be positive or None")
    names = [f.strip().split(" ")[0] for f in SLICES.split(",")]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
        for batch in batches:
            books, a = batch.column("book_id").to_pylist(), 0
            while a < len(books):
                b = len(books) if books[-1] == books[a] else next(i for i in range(a + 1, len(books)) if books[i] != books[a])
                yield books[a], batch.slice(a, b - a)
                a = b

    def lists(runs_: Iterator[tuple[str, pa.RecordBatch]]) -> Iterator[Batch]:
        for _, run in runs_:
            yield run.column("text").to_pylist(), run.column("chars").to_numpy(), run.column("tokens").to_numpy()

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for book_id, its in groupby(runs(batches), lambda r: r[0]):
            rows, size = [], 0
            for s in slice_lines(lists(its), options, clients_of(providers, options, make), max_slices, answers=AnswerFolder(answers) if answers else None):
                rows.append({"book_id": book_id, **vars(s)})
                size += len(s.text or "")
                if size > OUT_AT_ONCE or len(rows) > 10_000:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([(n, pa.int64() if f.strip().endswith(" long") else pa.string()) for n, f in zip(names, SLICES.split(","), strict=True)])
    sized = lines.select("book_id", "line_no", "text", *(F.col(c) if c in lines.columns else e(F.col("text")).alias(c) for c, e in (("chars", count_chars), ("tokens", estimate_tokens))))
    ordered = sized.repartition("book_id").sortWithinPartitions("book_id", "line_no")
    return ordered.select("book_id", "text", "chars", "tokens").mapInArrow(sliced, SLICES)
