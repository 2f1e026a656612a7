"""Plain sequential versions of the operators, to hold the Spark forms against."""

from __future__ import annotations

import re
import unicodedata

ENDS, CLOSE, OPEN = "。！？!?", "”’」』》〉】）", "“‘「『《〈"


def normalize(text):
    text = re.sub("\r\n?", "\n", text)
    text = "".join(" " if c in " 　" else c for c in text if c not in "﻿​‌‍⁠")
    text = "".join(c for c in text if c == "\n" or not unicodedata.category(c).startswith("C"))
    text = re.sub(" +", " ", text)
    text = re.sub(" ?\n ?", "\n", text)
    return re.sub("\n{3,}", "\n\n", text).strip()


def sentences(text):
    out, buf, ended, dots = [], "", False, 0
    for c in text:
        if ended and c not in CLOSE:
            out.append(buf)
            buf, ended, dots = c, False, int(c == "…")
            continue
        if ended:
            buf += c
            continue
        if c == "\n":
            out.append(buf)
            buf, dots = "", 0
            continue
        buf += c
        dots = dots + 1 if c == "…" else 0
        ended = c in ENDS or dots == 2
        dots = 0 if ended else dots
    return [s for s in (x.strip() for x in [*out, buf]) if s]


def clean(paras, rules, is_any, is_strict, is_title, skip):
    """(lines, hits) of one book's paragraphs."""
    lines, hits, on, left = [], [], False, 0
    for p in paras:
        if is_any(p):
            on = is_strict(p)
            left = skip if on else 0
            continue
        if not on:
            continue
        if left and is_title(p):
            left -= 1
            continue
        left = 0
        if lines:
            bare = p.lstrip(CLOSE)
            if bare != p:
                lines[-1] += p[: len(p) - len(bare)]
                p = bare.lstrip()
        done, held = [], ""
        for s in sentences(p):
            for name, kind, pattern, new in rules:
                if s and re.search(pattern, s):
                    hits.append((name, s))
                    s = {"drop": None, "extract": ""}.get(kind, s) if kind != "replace" else re.sub(pattern, new, s)
            s = (s or "").strip()
            if not s:
                continue
            s = held + s
            held = ""
            if all(c in OPEN for c in s):
                held = s
            elif all(c in CLOSE for c in s) and done:
                done[-1] += s
            else:
                done.append(s)
        if held and done:
            done[-1] += held
        elif held and lines:
            lines[-1] += held
        line = ""
        for s in done:
            line += (" " if line and re.search("[A-Za-z0-9]$", line) and re.match("[A-Za-z0-9]", s) else "") + s
        if line.strip():
            lines.append(line.strip())
    return lines, hits


def cut_end(sizes, at, low, high):
    """0-based index of the last line of a slice from ``at``."""
    total, best = 0, None
    for i in range(at, len(sizes)):
        total += sizes[i]
        if low <= total <= high:
            away = abs(total - (low + high) // 2)
            if best is None or away < best[0]:
                best = away, i
        if total > high:
            return best[1] if best else i
    return best[1] if best else len(sizes) - 1
