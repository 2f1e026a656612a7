"""Rule chains over arrays of sentences.

Each rule is one higher-order step over the array, so the plan grows linearly with the rules.  A chain
with a pattern that Java can't express runs as a whole in Python's ``re``, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from inkmill.functions.regexes import Untranslatable, may_be_empty, replacement_to_java, to_java
from inkmill.functions.text import strip
from inkmill.plans.config import KINDS, Rule

MATCHES = "array<struct<rule:string,bucket:string,text:string>>"
RESULT = f"array<struct<cur:string,matches:{MATCHES}>>"


def apply_rules(sentences: Column, rules: Sequence[Rule]) -> Column:
    """For every sentence what is left of it (null: dropped) and its hits, each with the text as that rule met it.

    A rule of an unknown kind fails where it hits.
    """
    try:
        steps = [_step(rule) for rule in rules]
    except Untranslatable:
        return _in_python(rules)(sentences)
    out = F.transform(sentences, lambda x: F.struct(x.alias("cur"), F.array().cast(MATCHES).alias("matches")))
    for step in steps:
        out = F.transform(out, step)
    return out


def _step(rule: Rule):
    if rule.kind == "replace" and may_be_empty(rule.pattern.text, rule.pattern.flags):
        raise Untranslatable(rule.pattern.text)
    pattern = to_java(rule.pattern.text, rule.pattern.flags)
    new_text = replacement_to_java(rule.replacement) if rule.kind == "replace" else ""

    def step(state: Column) -> Column:
        cur, matches = state["cur"], state["matches"]
        hit = F.coalesce((cur != "") & cur.rlike(pattern), F.lit(False))
        left = {"drop": F.lit(None).cast("string"), "extract": F.lit("")}.get(rule.kind)
        if rule.kind == "replace":
            left = F.regexp_replace(cur, pattern, new_text)
        elif left is None:
            left = F.raise_error(F.lit(_unknown(rule))).cast("string")
        row = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.bucket).alias("bucket"), cur.alias("text"))
        return F.when(hit, F.struct(left.alias("cur"), F.concat(matches, F.array(row)).alias("matches"))).otherwise(state)  # one test for both

    return step


def _unknown(rule: Rule) -> str:
    return f"rule {rule.name!r} hit, but its kind is unknown: {rule.kind!r}"


def _in_python(rules: Sequence[Rule]):
    @F.pandas_udf(RESULT)
    def run(series: pd.Series) -> pd.Series:
        compiled = [(r, r.pattern.compiled()) for r in rules]

        def one(text: str) -> dict:
            cur, matches = text, []
            for rule, pattern in compiled:
                if not cur or not pattern.search(cur):
                    continue
                if rule.kind not in KINDS:
                    raise ValueError(_unknown(rule))
                matches.append({"rule": rule.name, "bucket": rule.bucket, "text": cur})
                cur = {"drop": None, "extract": ""}[rule.kind] if rule.kind != "replace" else pattern.sub(rule.replacement, cur)
                if cur is None:
                    break
            return {"cur": cur, "matches": matches}

        return series.map(lambda found: None if found is None else [one(s) for s in found])

    return run


def kept(results: Column) -> Column:
    """What is left, stripped, without blanks."""
    return F.filter(F.transform(results, lambda x: strip(x["cur"])), lambda x: x.isNotNull() & (x != ""))


def hits(results: Column) -> Column:
    return F.flatten(F.transform(results, lambda x: x["matches"]))
