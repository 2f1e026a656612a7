"""Headings, and which paragraphs belong to a chapter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmill.functions.regexes import ONLY_DIGITS, to_java
from inkmill.functions.text import looks_like_title, strip
from inkmill.plans.config import Headings, Pattern


def _from_start(text: Column, pattern: Pattern) -> Column:
    return text.rlike(rf"\A(?:{to_java(pattern.text, pattern.flags)})")


def _fits(text: Column, headings: Headings) -> Column:
    return (text != "") & (F.length(text) <= headings.max_len)


def is_any_heading(text: Column, headings: Headings) -> Column:
    line = strip(text)
    kinds = [_from_start(line, p) for p in (headings.generic, *headings.others)]
    if headings.digit_only:
        kinds.append(line.rlike(ONLY_DIGITS))
    return _fits(line, headings) & reduce(Column.__or__, kinds)


def is_strict_heading(text: Column, headings: Headings) -> Column:
    line = strip(text)
    return _fits(line, headings) & _from_start(line, headings.strict)


def flag(paragraphs: DataFrame, headings: Headings) -> DataFrame:
    """Add is_any and is_strict (only looked at where is_any)."""
    any_ = is_any_heading(F.col("text"), headings)
    return paragraphs.withColumn("is_any", any_).withColumn("is_strict", F.col("is_any") & is_strict_heading(F.col("text"), headings))


def include(paragraphs: DataFrame, headings: Headings) -> DataFrame:
    """Add included: under a strict heading with no other heading since; headings are never included."""
    so_far = Window.partitionBy("book_id").orderBy("para_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.when(F.col("is_any"), F.col("is_strict")), ignorenulls=True).over(so_far)
    return flag(paragraphs, headings).withColumn("included", ~F.col("is_any") & F.coalesce(last, F.lit(False)))


def skip_titles(included: DataFrame, headings: Headings) -> DataFrame:
    """Add skipped: one of the first title-like paragraphs right after a strict heading."""
    so_far = Window.partitionBy("book_id").orderBy("para_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    section = included.withColumn("section", F.sum(F.col("is_any").cast("long")).over(so_far))
    inside = Window.partitionBy("book_id", "section").orderBy("para_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    title = F.col("is_any") | looks_like_title(F.col("text"), headings.leading_title_max_len)
    # the heading itself is the section's first row and counts as a title
    place = F.count("*").over(inside) - F.max(F.col("is_any").cast("int")).over(inside)
    run = F.min(title).over(inside)
    return section.withColumn("skipped", F.col("included") & run & (place <= headings.skip_leading_titles)).drop("section")
