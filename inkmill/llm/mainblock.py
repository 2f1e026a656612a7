"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one for each block element.  Lines inside an article or main element and lines
outside make two distributions.  The weight of an outside line is its text without links; a line inside
weighs all its text and SURGE more, so that it surges by itself.  Weights are summed over sliding windows of
lines: the surge point is where a window first passes the threshold, the dive point where windows fall to
zero.  Of all stretches between a surge and its dive the one with most text is the main text, text inside
an article counting MARKED_WEIGHT times.

Scripts, styles and comments are no text.  Menus, footers, forms and the like, by their element, role or class,
leave a gap of empty lines, or nothing inside an article.  Of a header inside an article its headings stay.
A form, or an element named by class only, is no boilerplate if it holds most of the text of a page without
article; reader comments always are, whatever element they are.

Defined cases: a null page is empty; a page without text gives an empty string; cut-off tags vanish and
cut-off references stay as they are; an element that is not closed ends with its parent, or with the page;
boilerplate around an article ends where that begins; end tags that close nothing are ignored, and so are
start tags of title, textarea, iframe, template and noscript elements that never end, while an unclosed
script or style takes the rest of the page, as in browsers; repeated rows give repeated results, columns other
than the three named ones are ignored, so clashing names do no harm; an empty table gives an empty table.
Time and memory are linear in the page, however long; nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import map_rows

WINDOW = 3
#: A surge needs so many characters in a window, or a quarter of the fullest window where that is less.
SURGE = 80
#: A character inside an article or main element counts as so many outside.
MARKED_WEIGHT = 20

# Element names of the HTML standard by role, and words that mark boilerplate.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe".split())
FOREIGN = frozenset("svg math".split())
BREAKOUT = frozenset("article main body div p ul ol li dl table section header footer nav aside form h1 h2 h3 h4 h5 h6 blockquote pre".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DROPPED = frozenset("nav footer aside form button select dialog menu".split())
COMMENTS = frozenset("comment comments disqus reply replies respond".split())
MARKED = COMMENTS | frozenset("ad ads advert advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies footer header masthead menu modal nav navbar navigation newsletter notice pagination popup promo promoted related share sharing sidebar social sponsor sponsored subscribe toolbar widget".split())
#: A class with one of these words tells of the page's layout, not of the element.
LAYOUT = frozenset("no without has with not hide hidden is open closed enabled disabled".split())
ROLES = frozenset("banner navigation complementary contentinfo search menu menubar dialog alertdialog form".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(?<!-)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORD = re.compile(r"[a-z]+")
BLANK = re.compile(r"\s+")
_ENDS = {name: re.compile(rf"</{name}\b[^>]*>?", re.I) for name in RAW}


class Tag(NamedTuple):
    start: int
    stop: int
    name: str
    shut: bool
    attributes: str


class Line(NamedTuple):
    text: str  # empty for a gap
    own: int  # characters outside links
    marked: bool  # inside an article or main element
    box: int  # the form or named element around it that may be boilerplate; 0 for none


def _tags(page: str) -> list[Tag]:
    """All tags, with elements of raw text as one tag each; comments and declarations are nameless."""
    found: list[Tag] = []
    endless: set[str] = set()
    at = 0
    while m := TAG.search(page, at):
        shut, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        name, at = (name or "").lower(), m.end()
        if name in RAW:
            end = None if shut or name in endless else _ENDS[name].search(page, at)
            if end:
                at = end.end()
            elif not shut:
                endless.add(name)
                if name in ("script", "style"):
                    at = len(page)
            name = ""
        found.append(Tag(m.start(), at, name, bool(shut), attributes or ""))
    return found


def _ends(tags: list[Tag], size: int) -> list[tuple[int, int]]:
    """For every start tag the first tag behind its element, and the position where text goes on."""
    ends = [(len(tags), size)] * len(tags)
    stack: list[int] = []
    open_names: Counter[str] = Counter()
    for i, t in enumerate(tags):
        if not t.name or t.name in VOID:
            continue
        if not t.shut:
            if t.name not in FOREIGN or not t.attributes.endswith("/"):
                stack.append(i)
                open_names[t.name] += 1
            continue
        while open_names[t.name]:
            top = stack.pop()
            open_names[tags[top].name] -= 1
            if tags[top].name == t.name:
                ends[top] = i + 1, t.stop
                break
            ends[top] = i, t.start  # closed by its parent's end
    return ends


def _marks(attributes: str) -> set[str]:
    """Which of "role", "comments" and "class" make an element boilerplate."""
    found = set()
    for kind, value in ATTRIBUTE.findall(attributes):
        value = value.strip("\"'").lower()
        if kind.lower() == "role":
            if value.strip() in ROLES:
                found.add("class" if value.strip() == "form" else "role")
            continue
        for name in value.split():
            words = set(WORD.findall(name))
            if words.isdisjoint(LAYOUT):
                if not COMMENTS.isdisjoint(words):
                    found.add("comments")
                elif not MARKED.isdisjoint(words):
                    found.add("class")
    return found


def lines_of(page: str) -> list[Line]:
    """The lines of a page; whole boilerplate is left out, boxes that may be boilerplate are numbered."""
    tags = _tags(page)
    ends = _ends(tags, len(page))
    articles = [i for i, t in enumerate(tags) if t.name in ("article", "main") and not t.shut and "comments" not in _marks(t.attributes)]
    lines: list[Line] = []
    held: list[str] = []
    linked = 0  # characters of the line inside links
    in_link = marked = False
    main_end = box_end = header_end = heading_end = 0  # positions where these end
    box = boxes = line_box = 0

    def close() -> None:
        nonlocal linked
        text = BLANK.sub(" ", html.unescape("".join(held))).strip()
        if text:
            lines.append(Line(text, max(0, len(text) - linked), marked, line_box))
        held.clear()
        linked = 0

    def until_article(i: int) -> tuple[int, int]:
        """The end of the element that tag i starts, or the article in it."""
        k = bisect_right(articles, i)
        return (articles[k], tags[articles[k]].start) if k < len(articles) and articles[k] < ends[i][0] else ends[i]

    i = at = 0
    while i <= len(tags):
        upto = tags[i].start if i < len(tags) else len(page)
        if upto > at and not heading_end <= at < header_end:
            if not held:
                marked, line_box = at < main_end, box if at < box_end else 0
            held.append(page[at:upto])
            linked += (upto - at) * in_link
        if i == len(tags):
            break
        _, stop, name, shut, attributes = tags[i]
        opens = not shut and name not in VOID
        behind = i + 1, max(at, stop)  # where to go on
        if name == "br":
            held.append(" ")
        elif name == "a":
            in_link = opens
        elif name in FOREIGN:
            if opens and not attributes.endswith("/"):
                closed = ends[i][0] > i + 1 and tags[ends[i][0] - 1][2:4] == (name, True)
                j = None if closed else next((j for j in range(i + 1, ends[i][0]) if tags[j].name in BREAKOUT), None)
                behind = ends[i] if j is None else (j, tags[j].start)
        elif name in INLINE:
            if opens and attributes and _marks(attributes):
                behind = ends[i]
        elif name:
            close()
            in_link = False
            if opens:
                inside = at < main_end or stop <= main_end
                marks = _marks(attributes) if attributes else set()
                skipped = False
                if name in ("html", "body"):
                    pass
                elif "comments" in marks:
                    skipped, behind = True, ends[i]
                elif name in ("article", "main"):
                    main_end = max(main_end, ends[i][1])
                elif name == "header" and inside:
                    header_end, heading_end = ends[i][1], 0
                elif name in DROPPED and name != "form" or name == "header" or "role" in marks:
                    skipped, behind = True, until_article(i)
                elif (name == "form" or marks) and inside:
                    skipped, behind = True, until_article(i)
                elif (name == "form" or marks) and stop > box_end:
                    boxes += 1
                    box, box_end = boxes, until_article(i)[1]
                elif name in HEADINGS and stop <= header_end:
                    heading_end = ends[i][1]
                if skipped and not inside:
                    lines += [Line("", 0, False, 0)] * 2
        i, at = behind
    close()
    return lines


def _stretches(weights: list[int], window: int, surge: int) -> Iterator[tuple[int, int]]:
    """Half-open ranges of lines from a surge to its dive."""
    n = len(weights)
    sums = [0, *accumulate(weights)]
    block = [sums[min(n, i + window)] - sums[i] for i in range(n)]
    threshold = max(1, min(surge, max(block, default=0) // 4))
    i = 0
    while i < n:
        if block[i] < threshold:
            i += 1
            continue
        start = next(j for j in range(i, n) if weights[j])
        stop = i
        while stop < n and block[stop]:
            stop += 1
        yield start, stop
        i = stop + 1


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """The text between the surge and the dive of the fullest stretch, one line a block."""
    lines = lines_of(page or "")
    kept = set()
    if not any(x.marked and x.text for x in lines):
        in_box: Counter[int] = Counter()
        for x in lines:
            in_box[x.box] += len(x.text)
        kept = {b for b, n in in_box.items() if 2 * n > in_box.total()}
    lines = [x if not x.box or x.box in kept else Line("", 0, False, 0) for x in lines]
    best: tuple[int, list[str]] = 0, []
    for marked in (True, False):
        weights = [(len(x.text) + surge if marked else x.own) if x.text and x.marked == marked else 0 for x in lines]
        for a, b in _stretches(weights, window, surge) if any(weights) else ():
            size = sum(weights[a:b]) * (MARKED_WEIGHT if marked else 1)
            if size > best[0]:
                best = size, [x.text for x in lines[a:b] if x.text and x.marked == marked]
    return "\n".join(best[1])


def extract(df: DataFrame, key: str, url: str, page: str) -> DataFrame:
    """(key, url, text, n_chars) of every page."""

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for k, u, p in source:
            text = main_text(p)
            yield k, u, text, len(text)

    picked = df.select(F.col(key).alias("k"), F.col(url).alias("u"), F.col(page).alias("p"))
    kind = picked.schema["k"].dataType.simpleString()
    return map_rows(picked, f"{key} {kind}, {url} string, text string, n_chars long", rows)
