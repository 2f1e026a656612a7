"""Text functions as columns: they stay inside the JVM and compose with any plan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkmill.functions.regexes import CONTROL, LINE_END, SPACE_CLASS, SPACES

# The quotation marks, sentence ends and title characters of the cleaning rules.
CLOSE_QUOTES = "”’」』》〉】）"
OPEN_QUOTES = "“‘「『《〈"
SENTENCE_ENDS = "。！？!?"
TITLE_CHARACTERS = r"0-9A-Za-z\u4e00-\u9fff《》〈〉「」『』“”‘’·—\-？！!?… "
ZERO_WIDTH = "\ufeff\u200b\u200c\u200d\u2060"

#: Stands before a paragraph while it is cut into sentences; normalised text can't hold it.
SENTINEL = "\ue000"
_END, _BODY, _QUOTES = f"[{SENTENCE_ENDS}]", f"[^{SENTENCE_ENDS}…]", f"[{CLOSE_QUOTES}]"
# possessive, since a single ellipsis is passed only where plain characters follow; nothing is ever given back
_TAIL = f"{_BODY}*+(?:…{_BODY}++)*+(?:…?{_END}|……){_QUOTES}*+"
#: The first character of a sentence never ends it, hence the free character at the front.
SENTENCE = f"(?s)[^…]{_TAIL}|[^…].*|{_TAIL}|.+"


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(text, F.lit(SPACES))


def strip_left(text: Column) -> Column:
    return F.ltrim(text, F.lit(SPACES))


def normalize(text: Column) -> Column:
    """Unify line ends and blanks, drop control and zero-width characters, and squeeze blanks and blank lines."""
    unified = F.regexp_replace(text, r"\r\n?", "\n")
    unified = F.regexp_replace(unified, "[\u00a0\u3000]", " ")
    cleaned = F.regexp_replace(unified, CONTROL, "")  # zero-width characters are among these
    squeezed = F.regexp_replace(F.regexp_replace(cleaned, " {2,}", " "), " ?\n ?", "\n")
    return strip(F.regexp_replace(squeezed, "\n{3,}", "\n\n"))


def paragraphs(text: Column) -> Column:
    """Non-blank stripped lines as an array."""
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")


def split_lines(text: Column) -> Column:
    """Non-blank stripped pieces between any of the line ends that Python knows."""
    return F.filter(F.transform(F.split(text, LINE_END), strip), lambda x: x != "")


def sentences(paragraph: Column) -> Column:
    """Sentences of a paragraph, stripped, without blank ones."""
    found = F.regexp_extract_all(F.concat(F.lit(SENTINEL), paragraph), F.lit(SENTENCE), F.lit(0))
    return F.filter(F.transform(found, lambda x: strip(F.replace(x, F.lit(SENTINEL), F.lit("")))), lambda x: x != "")


#: White space but the plain blank.  The first part is there for speed: it settles most characters in two steps.
_RARE_SPACE = rf"[\x00-\x20\x7f-\uffff&&[{SPACE_CLASS}]]+"


def _visible(text: Column) -> Column:
    return F.length(F.regexp_replace(F.replace(text, F.lit(" "), F.lit("")), _RARE_SPACE, ""))


def count_chars(text: Column) -> Column:
    """Characters that are not white space."""
    return _visible(text).cast("long")


def estimate_tokens(text: Column) -> Column:
    """Ideographs, and a quarter of the other visible characters, rounded up."""
    ideographs = F.length(F.regexp_replace(text, r"[^\u4e00-\u9fff]+", ""))
    return (ideographs + F.floor((_visible(text) - ideographs + 3) / 4)).cast("long")


def needs_space(before: Column, after: Column) -> Column:
    """Do two pieces meet in ASCII letters or digits?"""
    return F.substring(before, -1, 1).rlike("[A-Za-z0-9]") & F.substring(after, 1, 1).rlike("[A-Za-z0-9]")


def join_pieces(pieces: Column) -> Column:
    """Non-empty pieces in one string, with a space only where ``needs_space``; linear in their length."""

    def joined(p: Column) -> Column:
        return F.array_join(F.transform(p, lambda x, i: F.concat(F.when(needs_space(F.get(p, i - 1), x), F.lit(" ")).otherwise(F.lit("")), x)), "")

    return F.element_at(F.transform(F.array(pieces), joined), 1)


def looks_like_title(text: Column, max_len: int) -> Column:
    stripped = strip(text)
    return (F.length(stripped) <= max_len) & stripped.rlike(rf"\A[{TITLE_CHARACTERS}]+\z")


def only_open_quotes(text: Column) -> Column:
    return text.rlike(rf"\A[{OPEN_QUOTES}]+\z")


def only_close_quotes(text: Column) -> Column:
    return text.rlike(rf"\A[{CLOSE_QUOTES}]+\z")
