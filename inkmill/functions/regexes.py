"""Character classes and the translation of user patterns.

Rule files hold Python patterns, while Spark's expressions run Java's.  ``to_java`` rewrites what differs
and refuses what has no equal, so that callers can fall back to an Arrow function with Python's ``re``.
"""

from __future__ import annotations

import re
from functools import lru_cache

# White space as str.isspace() knows it; code points of category C.
#: White space, as the inside of a class that Java understands.
SPACE_CLASS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = f"[{SPACE_CLASS}]"
NOT_SPACE = f"[^{SPACE_CLASS}]"
#: The same characters, one by one.
SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
#: Line ends of str.splitlines().
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
#: Characters assigned after the Unicode version of Java 17, which it takes for unassigned.
NEWLY_ASSIGNED = (
    "61D 870-88E 898-89F 8B5 8C8-8D2 C3C C5D CDD CF3 ECE 170D 1715 171F 180F 1AC1-1ACE 1B4C 1B7D-1B7E 1DFA 20C0 2C2F 2C5F "
    "2E53-2E5D 2FFC-2FFF 31EF 9FFD-9FFF A7C0-A7C1 A7D0-A7D1 A7D3 A7D5-A7D9 A7F2-A7F4 FBC2 FD40-FD4F FDCF FDFE-FDFF "
    "10570-1057A 1057C-1058A 1058C-10592 10594-10595 10597-105A1 105A3-105B1 105B3-105B9 105BB-105BC 10780-10785 "
    "10787-107B0 107B2-107BA 10EFD-10EFF 10F70-10F89 11070-11075 110C2 1123F-11241 116B9 11740-11746 11AB0-11ABF "
    "11B00-11B09 11F00-11F10 11F12-11F3A 11F3E-11F59 12F90-12FF2 1342F 13440-13455 16A70-16ABE 16AC0-16AC9 1AFF0-1AFF3 "
    "1AFF5-1AFFB 1AFFD-1AFFE 1B11F-1B122 1B132 1B155 1CF00-1CF2D 1CF30-1CF46 1CF50-1CFC3 1D1E9-1D1EA 1D2C0-1D2D3 "
    "1DF00-1DF1E 1DF25-1DF2A 1E030-1E06D 1E08F 1E290-1E2AE 1E4D0-1E4F9 1E7E0-1E7E6 1E7E8-1E7EB 1E7ED-1E7EE 1E7F0-1E7FE "
    "1F6DC-1F6DF 1F774-1F776 1F77B-1F77F 1F7D9 1F7F0 1F979 1F9CC 1FA75-1FA77 1FA7B-1FA7C 1FA87-1FA88 1FAA9-1FAAF "
    "1FAB7-1FABD 1FABF 1FAC3-1FAC5 1FACE-1FACF 1FAD7-1FADB 1FAE0-1FAE8 1FAF0-1FAF8 2A6DE-2A6DF 2B735-2B739 2EBF0-2EE5D "
    "31350-323AF"
)
#: Digits of str.isdigit() beyond category Nd.
OTHER_DIGITS = (
    "B2-B3 B9 1369-1371 19DA 2070 2074-2079 2080-2089 2460-2468 2474-247C 2488-2490 24EA 24F5-24FD 24FF 2776-277E "
    "2780-2788 278A-2792 10A40-10A43 10E60-10E68 11052-1105A 1F100-1F10A"
)


def _ranges(listed: str) -> str:
    return "".join("-".join(f"\\x{{{x}}}" for x in r.split("-")) for r in listed.split())


#: One character of category C other than a line feed.
CONTROL = rf"[\p{{C}}&&[^\n{_ranges(NEWLY_ASSIGNED)}]]"
#: Only digits, as str.isdigit() sees it.
ONLY_DIGITS = rf"\A[\p{{Nd}}{_ranges(OTHER_DIGITS)}]+\z"


class Untranslatable(ValueError):
    """A Python pattern that Java's syntax can't express."""


_FLAGS = {"i": "(?iu)", "m": "", "s": "(?s)"}
#: Characters of \w as the inside of a class: letters, all kinds of numerals, and the underscore.
WORD_CLASS = r"\p{L}\p{N}_"
_WORD = f"[{WORD_CLASS}]"
_BOUNDARY = f"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"
#: Python has none in an empty text.
_NO_BOUNDARY = f"(?:(?!\\A\\z)(?:(?<={_WORD})(?={_WORD})|(?<!{_WORD})(?!{_WORD})))"
#: Escapes of one letter and their Java forms outside of a class and inside; None: there is none.
_ESCAPES = {
    "s": (SPACE, SPACE_CLASS),
    "S": (NOT_SPACE, None),
    "d": (r"\p{Nd}", r"\p{Nd}"),
    "D": (r"\P{Nd}", r"\P{Nd}"),
    "w": (_WORD, WORD_CLASS),
    "W": (f"[^{WORD_CLASS}]", None),
    "b": (_BOUNDARY, r"\x08"),
    "B": (_NO_BOUNDARY, None),
    "A": (r"\A", None),
    "Z": (r"\z", None),
    "v": (r"\x0B", r"\x0B"),
    "a": (r"\x07", r"\x07"),
    **{c: (f"\\{c}", f"\\{c}") for c in "nrtf"},
}
_ATOM = re.compile(
    r"""\\(?:(?P<octal>0[0-7]{0,2}|[0-3][0-7]{2})|(?P<back>[1-9][0-9]?)|x(?P<x>[0-9a-fA-F]{2})|u(?P<u>[0-9a-fA-F]{4})|U(?P<U>[0-9a-fA-F]{8})|(?P<esc>.))
    |\(\?P<(?P<name>\w+)>|\(\?P=(?P<named>\w+)\)|(?P<plain>\(\?(?:[:=!>]|<[=!]))|(?P<odd>\(\?)
    |(?P<open>\[\^?\]?)|\{(?P<least>[0-9]*)(?P<comma>,?)(?P<most>[0-9]*)\}|(?P<rest>.)""",
    re.S | re.X,
)


@lru_cache(512)
def to_java(pattern: str, flags: str = "") -> str:
    """Java form of a Python pattern; raises Untranslatable where there is none."""
    out = ["(?d)", *(_FLAGS[f] for f in flags)]
    at, in_class = 0, False
    while at < len(pattern):
        m = _ATOM.match(pattern, at)
        coded = m["octal"] and int(m["octal"], 8) or int(m["x"] or m["u"] or m["U"] or "0", 16)
        if in_class:
            text, at = _in_class(pattern, at, m, coded)
            in_class = text != "]"
            out.append(text)
            continue
        at = m.end()
        if m["odd"]:  # conditions, comments, flags inside of the pattern
            raise Untranslatable(pattern)
        if m["octal"] or m["x"] or m["u"] or m["U"]:
            text = f"\\x{{{coded:X}}}"
        elif m["esc"]:
            text = _escape(m["esc"], 0)
        elif m["back"]:
            text = f"(?:\\{m['back']})"  # a digit behind it is no part of its number
        elif m["name"]:
            text = f"(?<{_group(m['name'])}>"
        elif m["named"]:
            text = f"\\k<{_group(m['named'])}>"
        elif m["open"]:
            in_class = True
            text = m["open"].replace("]", "\\]")
        elif m["least"] is not None and (m["least"] or m["most"] or m["comma"]):
            text = f"{{{m['least'] or 0}{m['comma']}{m['most']}}}"
        elif m[0] in ("{}", "{", "}"):
            text = m[0].replace("{", "\\{").replace("}", "\\}")
        elif m[0] == "$":
            text = "(?=\\n|\\z)" if "m" in flags else "(?=\\n?\\z)"
        elif m[0] == "^" and "m" in flags:
            text = "(?<![^\\n])"
        else:
            text = m[0]
        out.append(text)
    return "".join(out)


def may_be_empty(pattern: str, flags: str = "") -> bool:
    """Can the pattern match without reading a character?  Java finds such matches inside of characters beyond the BMP, too."""
    compiled = re.compile(pattern, sum({"i": re.I, "m": re.M, "s": re.S}[f] for f in flags))
    return re._parser.parse(pattern, compiled.flags & ~re.UNICODE).getwidth()[0] == 0


def _in_class(pattern: str, at: int, m: re.Match, coded: int) -> tuple[str, int]:
    """The Java form of what stands at a place inside of a class, and where it ends."""
    if pattern[at] == "[" or pattern.startswith("&&", at):
        raise Untranslatable(pattern)
    if pattern[at] != "\\":
        return pattern[at], at + 1
    if m["back"]:
        digits = re.match("[0-7]{1,3}", m["back"])
        if not digits or len(digits[0]) != len(m["back"]):
            raise Untranslatable(pattern)
        return f"\\x{{{int(digits[0], 8):X}}}", m.end()
    if m["esc"]:
        return _escape(m["esc"], 1), m.end()
    return f"\\x{{{coded:X}}}", m.end()


def _group(name: str) -> str:
    if not re.fullmatch("[A-Za-z][A-Za-z0-9]*", name):
        raise Untranslatable(name)
    return name


def _escape(c: str, where: int) -> str:
    if c in _ESCAPES:
        text = _ESCAPES[c][where]
    else:
        text = None if c.isascii() and c.isalnum() else f"\\{c}" if c.isascii() else c
    if text is None:
        raise Untranslatable(f"\\{c}")
    return text


@lru_cache(512)
def replacement_to_java(replacement: str) -> str:
    """Java form of the second argument of re.sub."""
    out, at = [], 0
    for m in re.finditer(r"\\g<(\w+)>|\\(\d{1,3})|\\(.)", replacement, re.S):
        out.append(_literal(replacement[at : m.start()], out))
        name = m[1] or m[2]
        if m[2] and (m[2][0] == "0" or len(m[2]) == 3):  # an octal number, or a group and a digit
            raise Untranslatable(replacement)
        if name:
            out.append(f"${name}" if name.isdigit() else f"${{{_group(name)}}}")
        else:
            plain = {"n": "\n", "t": "\t", "r": "\r", "f": "\f", "v": "\v", "a": "\a", "\\": "\\\\"}.get(m[3])
            if plain is None:
                raise Untranslatable(replacement)
            out.append(plain)
        at = m.end()
    out.append(_literal(replacement[at:], out))
    return "".join(out)


def _literal(text: str, before: list[str]) -> str:
    """Plain text of a replacement; a digit behind a group's number is kept apart from it."""
    apart = text[:1].isdigit() and text[0].isascii() and before and re.fullmatch(r"\$\d+", before[-1])
    return ("\\" if apart else "") + text.replace("$", "\\$")
