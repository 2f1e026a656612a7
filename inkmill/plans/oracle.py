"""DuckDB SQL of the registered queries, put together from shared pieces."""

from __future__ import annotations

from inkmill.functions import text as T
from inkmill.plans.config import Headings, SliceOptions

WS = r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_END, _BODY, _QUOTES = f"[{T.SENTENCE_ENDS}]", f"[^{T.SENTENCE_ENDS}…]", f"[{T.CLOSE_QUOTES}]"
_TAIL = f"(?:…?{_BODY})*(?:…?{_END}|……){_QUOTES}*"
SENTENCE = f"(?s)[^…]{_TAIL}|[^…].*|{_TAIL}|.+"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}+|{WS}+$', '', 'g')"


def normalize(e: str) -> str:
    e = rf"regexp_replace({e}, '\r\n?', chr(10), 'g')"
    e = f"translate({e}, chr(160) || chr(12288) || {' || '.join(f'chr({ord(c)})' for c in T.ZERO_WIDTH)}, '  ')"
    e = rf"regexp_replace({e}, '[\x{{00}}-\x{{09}}\x{{0B}}-\x{{1F}}\x{{7F}}-\x{{9F}}\x{{AD}}]|\p{{Cf}}|\p{{Co}}', '', 'g')"
    e = f"regexp_replace(regexp_replace({e}, ' +', ' ', 'g'), ' ?\\n ?', chr(10), 'g')"
    return strip(rf"regexp_replace({e}, '\n{{3,}}', chr(10) || chr(10), 'g')")


def pieces(e: str) -> str:
    """Non-blank stripped elements of a list of strings."""
    return f"list_filter(list_transform({e}, lambda x: {strip('x')}), lambda x: x <> '')"


def paragraphs(e: str) -> str:
    return pieces(f"string_split({e}, chr(10))")


def sentences(e: str) -> str:
    return pieces(f"list_transform(regexp_extract_all(chr(57344) || {e}, {q(SENTENCE)}), lambda y: replace(y, chr(57344), ''))")


def count_chars(e: str) -> str:
    return f"length(regexp_replace({e}, '{WS}', '', 'g'))"


def tokens(e: str) -> str:
    cjk = rf"length(regexp_replace({e}, '[^\x{{4E00}}-\x{{9FFF}}]', '', 'g'))"
    other = rf"length(regexp_replace({e}, '[\x{{4E00}}-\x{{9FFF}}]|{WS}', '', 'g'))"
    return f"({cjk} + ({other} + 3) // 4)"


def unnest(source: str, keys: str, list_expr: str, number: str, value: str, start: int = 1) -> str:
    """SELECT keys, number, value for every element of a list."""
    return f"SELECT {keys}, CAST(i + {start - 1} AS BIGINT) AS {number}, l[i] AS {value} FROM (SELECT {keys}, {list_expr} AS l FROM {source}) s, LATERAL (SELECT unnest(range(1, len(l) + 1)) AS i) g"


def matches_from_start(e: str, pattern: str, flags: str = "") -> str:
    return f"regexp_matches({e}, {q('^(?:' + pattern.replace(chr(92) + 's', WS) + ')')}{', ' + q(flags) if flags else ''})"


def any_heading(e: str, h: Headings) -> str:
    kinds = [matches_from_start(e, p.text, p.flags) for p in (h.generic, *h.others)]
    if h.digit_only:
        kinds.append(rf"regexp_matches({e}, '^\p{{Nd}}+$')")
    return f"({e} <> '' AND length({e}) <= {h.max_len} AND ({' OR '.join(kinds)}))"


def strict_heading(e: str, h: Headings) -> str:
    return f"({e} <> '' AND length({e}) <= {h.max_len} AND {matches_from_start(e, h.strict.text, h.strict.flags)})"


def title_like(e: str, h: Headings) -> str:
    allowed = T.TITLE_CHARACTERS.replace("\\u4e00-\\u9fff", "\\x{4E00}-\\x{9FFF}")
    return f"(length({e}) <= {h.leading_title_max_len} AND regexp_matches({e}, '^[{allowed}]+$'))"


def book_lines() -> str:
    """CTEs lines(book_id, line_no, text) and p(book_id, line_no, chars, tokens, total) of documents, one book a source."""
    paras = unnest("documents", "source, doc_id", paragraphs(normalize("text")), "pos", "text")
    return f"""paras AS ({paras}),
lines AS (SELECT source AS book_id, row_number() OVER (PARTITION BY source ORDER BY doc_id, pos) AS line_no, text FROM paras),
sized AS (SELECT book_id, line_no, CAST({count_chars('text')} AS BIGINT) AS chars, CAST({tokens('text')} AS BIGINT) AS tokens FROM lines),
p AS (SELECT *, CAST(sum(chars) OVER w AS BIGINT) AS total, CAST(sum(tokens + 1) OVER w AS BIGINT) AS packed, max(line_no) OVER (PARTITION BY book_id) AS last_line FROM sized WINDOW w AS (PARTITION BY book_id ORDER BY line_no))"""


def next_ends(o: SliceOptions) -> str:
    """CTEs up to nxt(book_id, after_line, end_line)."""
    return f"""{book_lines()},
origin AS (SELECT book_id, line_no, total, last_line FROM p UNION ALL SELECT DISTINCT book_id, 0, 0, last_line FROM p),
nxt AS (SELECT a.book_id, a.line_no AS after_line, coalesce(
    arg_min(b.line_no, {{'d': abs(b.total - a.total - {o.middle}), 'n': b.line_no}}) FILTER (b.total - a.total BETWEEN {o.target_chars_min} AND {o.target_chars_max}),
    min(b.line_no) FILTER (b.total - a.total > {o.target_chars_max}), max(b.line_no)) AS end_line
  FROM origin a JOIN p b ON a.book_id = b.book_id AND b.line_no > a.line_no GROUP BY 1, 2)"""


def dry_run(o: SliceOptions, limit: int | None = None) -> str:
    """SQL body with a relation slices(book_id, slice_id, start_line, end_line, char_len)."""
    stop = f" AND s.slice_id < {limit}" if limit else ""
    return f"""WITH RECURSIVE {next_ends(o)},
slices0 AS (SELECT book_id, CAST(1 AS BIGINT) AS slice_id, after_line, end_line FROM nxt WHERE after_line = 0
  UNION ALL SELECT n.book_id, s.slice_id + 1, n.after_line, n.end_line FROM slices0 s JOIN nxt n ON n.book_id = s.book_id AND n.after_line = s.end_line{' WHERE TRUE' + stop if stop else ''}),
slices AS (SELECT s.book_id, s.slice_id, s.after_line + 1 AS start_line, s.end_line, b.total - coalesce(a.total, 0) AS char_len
  FROM slices0 s JOIN p b ON b.book_id = s.book_id AND b.line_no = s.end_line LEFT JOIN p a ON a.book_id = s.book_id AND a.line_no = s.after_line)"""
