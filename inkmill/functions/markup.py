"""HTML to text.

``html_text`` feeds Python's own HTML parser in Arrow batches and so shares its treatment of broken
markup.  ``html_text_closed`` differs in one thing: a character reference needs its semicolon, as in XML,
so what was cut off inside of one stays as it is.  ``html_text_native`` is a chain of expressions for well-formed pages with a closed set of
character references; it never leaves the JVM.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Elements that break lines, and elements whose content is dropped.
LINE_BREAKING = frozenset("p div br hr li ul ol table tr td th h1 h2 h3 h4 h5 h6 blockquote pre".split())
SILENT = frozenset("script style head".split())

#: An ampersand that begins no reference with a semicolon.
_PLAIN_AMPERSAND = re.compile("&(?!(?:[A-Za-z][A-Za-z0-9]*|#[0-9]+|#[xX][0-9A-Fa-f]+);)")


class _TextOf(HTMLParser):
    """Collects visible text; a start or end of a line-breaking element is one line feed."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.found: list[str] = []
        self.silent = 0

    def _edge(self, tag: str, step: int) -> None:
        if tag in SILENT:
            self.silent = max(0, self.silent + step)
        elif tag in LINE_BREAKING:
            self._say("\n")

    def _say(self, text: str) -> None:
        if not self.silent:
            self.found.append(text)

    def handle_starttag(self, tag, attrs):
        self._edge(tag, 1)

    def handle_endtag(self, tag):
        self._edge(tag, -1)

    def handle_data(self, data):
        self._say(data)

    def handle_entityref(self, name):
        self._say(html.unescape(f"&{name};"))

    def handle_charref(self, name):
        self._say(html.unescape(f"&#{name};"))


def text_of(page: bytes | str | None, closed: bool = False) -> str | None:
    """Visible text of one page; bytes are UTF-8 with faulty ones replaced.  ``closed``: references need their semicolon."""
    if page is None:
        return None
    parser = _TextOf()
    page = page if isinstance(page, str) else bytes(page).decode("utf-8", errors="replace")
    parser.feed(_PLAIN_AMPERSAND.sub("&amp;", page) if closed else page)
    parser.close()
    return "".join(parser.found)


@F.pandas_udf(StringType())
def html_text(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for series in pages:
        yield series.map(text_of, na_action="ignore")


@F.pandas_udf(StringType())
def html_text_closed(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for series in pages:
        yield series.map(lambda page: text_of(page, closed=True), na_action="ignore")


def html_text_native(page: Column) -> Column:
    """The same for pages with closed elements and only the references amp, copy, middot, quot, lt, gt and nbsp."""
    silent = F.regexp_replace(page, r"(?is)<(head|script|style)\b.*?</\1\s*>", "")
    silent = F.regexp_replace(silent, r"(?s)<!--.*?-->|<![^>]*>", "")
    double = F.regexp_replace(silent, rf"(?i)<(?:{'|'.join(sorted(LINE_BREAKING))})(?:\s[^<>]*)?/>", "\n\n")
    broken = F.regexp_replace(double, rf"(?i)</?(?:{'|'.join(sorted(LINE_BREAKING))})(?:\s[^<>]*)?>", "\n")
    plain = F.regexp_replace(broken, r"</?[A-Za-z][^<>]*>", "")
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("nbsp", "\u00a0"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        plain = F.replace(plain, F.lit(f"&{name};"), F.lit(char))
    return plain
