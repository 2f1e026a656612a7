"""The prompt of a slicing request: a template with placeholders, and the numbered lines."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkmill.plans.config import CONFIG_DIR

TEMPLATE = CONFIG_DIR / "prompt.md"


@lru_cache(8)
def sections(path: Path = TEMPLATE) -> tuple[str, str]:
    """The texts under '## system' and '## user'; what stands elsewhere is for readers."""
    found: dict[str, list[str]] = {}
    current = None
    for line in path.read_text(encoding="utf-8").splitlines():
        if head := re.match(r"##\s+(\S+)\s*$", line):
            current = head[1].lower()
        elif current:
            found.setdefault(current, []).append(line)
    system, user = ("\n".join(found.get(name, [])).strip() for name in ("system", "user"))
    if not system or not user:
        raise ValueError(f"{path} needs a system and a user section")
    return system, user


class LongText:
    """A message's text that is read in pieces of whole lines, since it may be too long for memory; str() is all of it."""

    def __init__(self, pieces: Callable[[], Iterable[str]]):
        self.pieces = pieces

    def __iter__(self) -> Iterator[str]:
        return iter(self.pieces())

    def __str__(self) -> str:
        return "".join(self)


def pieces_of(content: str | LongText) -> Iterable[str]:
    return [content] if isinstance(content, str) else content


def _request(start_line: int, low: int, high: int, path: Path) -> tuple[str, str]:
    system, user = sections(path)
    for name, value in (("target_chars_min", low), ("target_chars_max", high), ("start_line", start_line)):
        user = user.replace("{{" + name + "}}", str(value))
    return system, user


def _messages(system: str, user: str | LongText) -> list[dict]:
    return [{"role": "system", "content": system}, {"role": "user", "content": user}]


def numbered(lines: Iterable[tuple[int, str]]) -> str:
    return "\n".join(f"{number}\t{text}" for number, text in lines)


def messages(start_line: int, lines: Iterable[tuple[int, str]], low: int, high: int, path: Path = TEMPLATE) -> list[dict]:
    """Chat messages for numbered lines; placeholders are filled in the template only."""
    system, user = _request(start_line, low, high, path)
    return _messages(system, f"{user}\n{numbered(lines)}")


def long_messages(start_line: int, blocks: Callable[[], Iterable[list[str]]], low: int, high: int, path: Path = TEMPLATE) -> list[dict]:
    """The same messages for blocks of lines that are read anew whenever the text is."""
    system, user = _request(start_line, low, high, path)

    def pieces() -> Iterator[str]:
        number, before = start_line, f"{user}\n"
        for texts in blocks():
            yield before + numbered(enumerate(texts, number))
            number, before = number + len(texts), "\n"

    return _messages(system, LongText(pieces))


def render_body(lines: Column) -> Column:
    """The numbered body of an array of (line_no, text)."""
    return F.array_join(F.transform(lines, lambda x: F.concat_ws("\t", x["line_no"].cast("string"), x["text"])), "\n")
