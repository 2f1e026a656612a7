"""Reading and checking the cut points that a model proposes.

Answers are read by Python's own JSON reader, in Arrow batches: Spark's readers take text that it refuses,
and a refused answer must be asked for again.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

CUT = StructType([StructField("end_line", LongType()), StructField("title", StringType()), StructField("summary", StringType())])
_OBJECT = re.compile(r"\{.*\}", re.S)


@dataclass(frozen=True, slots=True)
class Cut:
    end_line: int
    title: str | None = None
    summary: str | None = None


def json_object(answer: str) -> dict[str, Any]:
    """The object that the answer is, or that stands between its first and its last brace."""
    answer = answer.strip()
    if not answer:
        raise ValueError("the answer is empty")
    span = _OBJECT.search(answer)
    if not span:
        raise ValueError("the answer holds no JSON object")
    try:
        return json.loads(span[0])
    except ValueError as e:
        raise ValueError(f"the answer is not valid JSON: {e}") from e


def parse(answer: str) -> list[Cut]:
    """Cuts by line; the first of each line counts; entries without a whole-number line are passed over."""
    entries = json_object(answer).get("cuts")
    if not isinstance(entries, list):
        raise ValueError("the answer lacks a list of cuts")
    found: dict[int, Cut] = {}
    said = lambda v: v if isinstance(v, str) and v.strip() else None
    for i, e in enumerate(entries):
        entries[i] = None  # answers on whole books are long, so each entry goes as soon as it is read
        if isinstance(e, dict) and isinstance(e.get("end_line"), int):
            found.setdefault(int(e["end_line"]), Cut(int(e["end_line"]), said(e.get("title")), said(e.get("summary"))))
    return [found[line] for line in sorted(found)]


def validate(cuts: list[Cut], first: int, last: int) -> list[Cut]:
    """Those within the lines asked about."""
    return [c for c in cuts if first <= c.end_line <= last]


@F.pandas_udf(StructType([StructField("cuts", ArrayType(CUT)), StructField("error", StringType())]))
def parse_cuts(answers: pd.Series) -> pd.DataFrame:
    """(cuts, error) of every answer; just one of them is null."""

    def one(answer: str | None) -> tuple:
        try:
            return [asdict(c) for c in parse(answer or "")], None
        except ValueError as e:
            return None, str(e)

    return pd.DataFrame([one(a) for a in answers], columns=["cuts", "error"])


def within(cuts: Column, first: Column, last: Column) -> Column:
    return F.filter(cuts, lambda c: c["end_line"].between(first, last))
