"""Configuration: cleaning rules, headings, slicing options and providers, with their validation."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

KINDS = ("drop", "extract", "replace")
CONFIG_DIR = Path(__file__).resolve().parent.parent / "config"


def read_json(path: str | Path) -> Any:
    return json.loads(Path(path).read_text(encoding="utf-8"))


def _flags(value: Any) -> str:
    if value is None:
        return ""
    if not isinstance(value, str) or set(value) - set("ims"):
        raise ValueError(f"flags of a pattern are letters out of i, m and s, not {value!r}")
    return "".join(sorted(set(value)))


@dataclass(frozen=True)
class Pattern:
    """A Python regular expression with its flags as letters."""

    text: str
    flags: str = ""

    def __post_init__(self):
        self.compiled()

    def compiled(self) -> re.Pattern[str]:
        return re.compile(self.text, sum({"i": re.I, "m": re.M, "s": re.S}[f] for f in self.flags))

    @classmethod
    def of(cls, entry: Any) -> Pattern:
        if isinstance(entry, str):
            return cls(entry)
        if isinstance(entry, Mapping) and isinstance(entry.get("pattern"), str):
            return cls(entry["pattern"], _flags(entry.get("flags")))
        raise ValueError(f"a pattern must be text or an object with a pattern: {entry!r}")


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str
    pattern: Pattern
    bucket: str = "noise"
    replacement: str = ""


@dataclass(frozen=True)
class Headings:
    max_len: int
    strict: Pattern
    generic: Pattern
    others: tuple[Pattern, ...] = ()
    digit_only: bool = True
    skip_leading_titles: int = 0
    leading_title_max_len: int = 20

    @classmethod
    def parse(cls, data: Any) -> Headings:
        if not isinstance(data, Mapping):
            raise ValueError("heading must be an object")
        for name in ("strict_chapter_title", "generic_heading", "other_headings"):
            if name not in data:
                raise ValueError(f"heading.{name} is required")
        if not isinstance(data["other_headings"], list):
            raise ValueError("heading.other_headings must be a list")
        ints = {"max_len": 80, "skip_leading_titles": 0, "leading_title_max_len": 20}
        for name, default in ints.items():
            value = data.get(name, default)
            if isinstance(value, bool) or not isinstance(value, int) or value < (0 if name == "skip_leading_titles" else 1):
                raise ValueError(f"heading.{name} must be a whole number in range")
            ints[name] = value
        digit_only = data.get("digit_only", True)
        if not isinstance(digit_only, bool):
            raise ValueError("heading.digit_only must be true or false")
        return cls(ints["max_len"], Pattern.of(data["strict_chapter_title"]), Pattern.of(data["generic_heading"]), tuple(map(Pattern.of, data["other_headings"])), digit_only, ints["skip_leading_titles"], ints["leading_title_max_len"])


def parse_rules(data: Any) -> list[Rule]:
    """Rules of a rule file; entries that are no objects or have no pattern are passed over."""
    if data.get("version", 1) != 1:
        raise ValueError(f"this reads rule files of version 1, not {data.get('version')!r}")
    entries = data.get("rules", [])
    if not isinstance(entries, list):
        raise ValueError("rules must be a list")
    found = []
    for entry in entries:
        if not isinstance(entry, Mapping) or not entry.get("pattern"):
            continue
        kind = str(entry.get("kind") or "drop")
        bucket = str(entry.get("bucket") or ("solicitation" if kind == "extract" else "noise"))
        found.append(Rule(str(entry.get("name") or "rule"), kind, Pattern(str(entry["pattern"]), _flags(entry.get("flags"))), bucket, str(entry.get("replacement") or "")))
    return found


def load_cleaning(path: str | Path = CONFIG_DIR / "rules.json") -> tuple[list[Rule], Headings]:
    data = read_json(path)
    return parse_rules(data), Headings.parse(data.get("heading"))


@dataclass(frozen=True)
class ProviderOptions:
    name: str
    type: str
    base_url: str
    model: str
    api_key: str | None = field(default=None, repr=False)
    api_key_env: str | None = None

    def key(self) -> str:
        """The key itself, or the one that the environment holds; read where the calls are made."""
        for value in (self.api_key, os.environ.get(self.api_key_env) if self.api_key_env else None):
            if value and value.strip():
                return value.strip()
        raise ValueError(f"no API key for provider {self.name}")


def load_providers(path: str | Path) -> dict[str, ProviderOptions]:
    """Providers of a file; entries without type, base_url or model are passed over, but one must be whole."""
    entries = read_json(path).get("providers")
    if not isinstance(entries, Mapping):
        raise ValueError("providers must be an object")
    found = {}
    for name, e in entries.items():
        if isinstance(e, Mapping) and all(isinstance(e.get(k), str) and e[k].strip() for k in ("type", "base_url", "model")):
            found[name] = ProviderOptions(name, e["type"], e["base_url"], e["model"], e.get("api_key"), e.get("api_key_env"))
    if not found:
        raise ValueError("no valid provider")
    return found


#: The numbers of a slice file by their kind.
NUMBERS = {"retry_max": int, "retry_backoff_s": float, "timeout_s": float, "target_chars_min": int, "target_chars_max": int, "chunk_input_tokens": int, "completion_max_tokens": int, "temperature": float}


def _number(name: str, value: Any, kind: type) -> int | float:
    """Numbers may be written as text, and whole ones with a fraction, which is cut off."""
    try:
        return kind(value)
    except (TypeError, ValueError, OverflowError) as e:
        raise ValueError(f"{name} must be a number, not {value!r}") from e


# Names, defaults and ranges of a slice file's settings.
@dataclass(frozen=True)
class SliceOptions:
    provider_order: tuple[str, ...] = ()
    retry_max: int = 5
    retry_backoff_s: float = 1.0
    timeout_s: float = 120.0
    target_chars_min: int = 5000
    target_chars_max: int = 6000
    chunk_input_tokens: int = 14000
    completion_max_tokens: int = 800
    temperature: float = 0.2
    response_format: str | None = None

    def __post_init__(self):
        for name in ("retry_max", "target_chars_min", "target_chars_max", "chunk_input_tokens", "completion_max_tokens"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
        if self.retry_backoff_s < 0:
            raise ValueError("retry_backoff_s must not be negative")
        if self.target_chars_min > self.target_chars_max:
            raise ValueError("target_chars_min exceeds target_chars_max")
        if self.response_format not in (None, "json_object"):
            raise ValueError("response_format must be null or json_object")

    @classmethod
    def parse(cls, data: Any) -> SliceOptions:
        if not isinstance(data, Mapping):
            raise ValueError("slice config must be an object")
        order = data.get("provider_order") or []
        order = [order] if isinstance(order, str) else order
        if not isinstance(order, list) or not all(isinstance(x, str) and x for x in order):
            raise ValueError("provider_order must be a list of names")
        given = {k: _number(k, data[k], kind) for k, kind in NUMBERS.items() if k in data}
        return cls(tuple(order), **given, response_format=data.get("response_format"))

    @property
    def middle(self) -> int:
        return (self.target_chars_min + self.target_chars_max) // 2


def load_slicing(path: str | Path) -> SliceOptions:
    return SliceOptions.parse(read_json(path))
