"""Cutting numbered lines into chunks and slices.

Lengths add up, so everything works on prefix sums.  One step from a slice to the next is a set of
windows with value ranges; the chain of steps within a book is sequential by nature and runs in one
function for each book, over two numbers a line, while texts stay behind.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkmill.functions.text import count_chars, estimate_tokens
from inkmill.plans.config import SliceOptions

SLICES = "book_id string, slice_id long, start_line long, end_line long, char_len long"


def number_lines(paragraphs: DataFrame) -> DataFrame:
    """``paragraphs(book_id, para_no, ...)`` with line_no, numbered from 1, in place of para_no."""
    order = Window.partitionBy("book_id").orderBy("para_no")
    return paragraphs.withColumn("line_no", F.row_number().over(order).cast("long")).select("book_id", "line_no", *(c for c in paragraphs.columns if c not in ("book_id", "para_no", "line_no")))


def sizes(lines: DataFrame) -> DataFrame:
    """(book_id, line_no, chars, tokens) of lines with text, or of lines that have these numbers already."""
    if {"chars", "tokens"} <= set(lines.columns):
        return lines.select("book_id", "line_no", "chars", "tokens")
    return lines.select("book_id", "line_no", count_chars(F.col("text")).alias("chars"), estimate_tokens(F.col("text")).alias("tokens"))


def next_ends(lines: DataFrame, options: SliceOptions) -> DataFrame:
    """(book_id, after_line, end_line): where a slice ends that starts behind ``after_line``, for every line and 0.

    Among the ends that keep the slice within its range the one nearest the middle is taken, the earlier one
    of two; else the first that overflows it; else the last line.  Every frame starts at an end of its book, so
    a step costs the same in a book of any length.
    """
    so_far = Window.partitionBy("book_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sizes(lines).select("book_id", "line_no", F.sum("chars").over(so_far).alias("total"))
    origin = sums.select("book_id").distinct().select("book_id", F.lit(0).cast("long").alias("line_no"), F.lit(0).cast("long").alias("total"))
    points = sums.union(origin)
    low, mid, high = options.target_chars_min, options.middle, options.target_chars_max
    up_to = lambda n: Window.partitionBy("book_id").orderBy("total").rangeBetween(Window.unboundedPreceding, n)
    from_ = lambda n: Window.partitionBy("book_id").orderBy(F.desc("total")).rangeBetween(Window.unboundedPreceding, -n)
    at = F.struct("total", "line_no")
    found = points.select(
        "book_id",
        F.col("line_no").alias("after_line"),
        "total",
        F.max(at).over(up_to(mid)).alias("below"),
        F.min(at).over(from_(mid)).alias("above"),
        F.min("line_no").over(from_(high + 1)).alias("over"),
        F.max("line_no").over(Window.partitionBy("book_id")).alias("last"),
    )
    under, above = F.col("below.total") - F.col("total"), F.col("above.total") - F.col("total")
    below_line = F.when(under >= low, F.col("below.line_no"))
    above_line = F.when(above <= high, F.col("above.line_no"))
    inside = F.when(below_line.isNull() | (above - mid < mid - under), above_line)
    return found.filter("after_line < last").select("book_id", "after_line", F.coalesce(inside, below_line, "over", "last").alias("end_line"))


def _walk(total: np.ndarray, options: SliceOptions, limit: int | None) -> list[tuple[int, int]]:
    """Slices as (lines before, last line) of a book with these prefix sums; total[0] is 0."""
    low, mid, high = options.target_chars_min, options.middle, options.target_chars_max
    found, at, last = [], 0, len(total) - 1
    while at < last and (limit is None or len(found) < limit):
        base = total[at]
        lo, hi = np.searchsorted(total, [base + low, base + high + 1])
        if lo < hi:
            k = int(np.searchsorted(total, base + mid))
            near = [j for j in (k - 1, k) if lo <= j < hi]
            end = min(near, key=lambda j: (abs(int(total[j] - base) - mid), j))
        else:
            end = min(int(hi), last)
        found.append((at, end))
        at = end
    return found


def dry_run(lines: DataFrame, options: SliceOptions, max_slices: int | None = None) -> DataFrame:
    """SLICES by length alone: each from the line behind the last, as ``next_ends`` has it."""
    if max_slices is not None and max_slices <= 0:
        raise ValueError("max_slices must be positive or None")

    def book(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("line_no")
        total = np.concatenate([[0], rows["chars"].to_numpy().cumsum()])
        numbers = rows["line_no"].to_numpy()
        found = _walk(total, options, max_slices)
        return pd.DataFrame({"book_id": key[0], "slice_id": range(1, len(found) + 1), "start_line": [numbers[a] for a, _ in found], "end_line": [numbers[b - 1] for _, b in found], "char_len": [total[b] - total[a] for a, b in found]})

    return sizes(lines).select("book_id", "line_no", "chars").groupBy("book_id").applyInPandas(book, SLICES)


def chunks(lines: DataFrame, options: SliceOptions) -> DataFrame:
    """(book_id, chunk_no, start_line, end_line): lines packed while their token estimates fit the budget, one at least."""

    def book(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("line_no")
        total = np.concatenate([[0], (rows["tokens"].to_numpy() + 1).cumsum()])
        numbers, out, at = rows["line_no"].to_numpy(), [], 0
        while at < len(rows):
            end = chunk_end(total, at, options.chunk_input_tokens)
            out.append((key[0], len(out) + 1, numbers[at], numbers[end - 1]))
            at = end
        return pd.DataFrame(out, columns=["book_id", "chunk_no", "start_line", "end_line"])

    return sizes(lines).select("book_id", "line_no", "tokens").groupBy("book_id").applyInPandas(book, "book_id string, chunk_no long, start_line long, end_line long")


def chunk_end(total: np.ndarray, at: int, budget: int) -> int:
    """Index behind the last line of the chunk that starts at index ``at``; total holds prefix sums."""
    return max(at + 1, int(np.searchsorted(total, total[at] + budget, side="right")) - 1)


def best_cut(total: np.ndarray, at: int, ends: np.ndarray, options: SliceOptions) -> int | None:
    """That end (a line number) behind line ``at`` which leaves the slice nearest its range, then its middle, then the start.

    ``ends`` are in order; a few searches find the ends on both sides of the range and of its middle.
    """
    first = int(np.searchsorted(ends, at, side="right"))
    if first == len(ends):
        return None
    low, mid, high = (int(total[at]) + n for n in (options.target_chars_min, options.middle, options.target_chars_max))

    def before(bound: int, side: str) -> int:
        """How many ends have a prefix sum below the bound, or up to it."""
        a, b = first, len(ends)
        while a < b:
            m = (a + b) // 2
            if total[ends[m]] < bound or side == "right" and total[ends[m]] == bound:
                a = m + 1
            else:
                b = m
        return a

    def distance(i: int) -> tuple[int, int, int]:
        n = int(total[ends[i]])
        return max(low - n, n - high, 0), abs(n - mid), i

    near = set()
    for k in (before(low, "left"), before(mid, "left"), before(high, "right")):
        if k < len(ends):
            near.add(k)
        if k > first:  # of ends with equal sums the first
            near.add(before(int(total[ends[k - 1]]), "left"))
    return int(ends[min(near, key=distance)])


def choose_cuts(lines: DataFrame, cuts: DataFrame, options: SliceOptions) -> DataFrame:
    """SLICES from proposed ``cuts(book_id, end_line)``: again and again the best cut behind the last slice."""

    def book(key: tuple, rows: pd.DataFrame, proposed: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("line_no")
        total = np.concatenate([[0], rows["chars"].to_numpy().cumsum()])
        ends, out, at = np.unique(proposed["end_line"].to_numpy()), [], 0
        ends = ends[(ends >= 1) & (ends <= len(rows))]
        while (end := best_cut(total, at, ends, options)) is not None:
            out.append((rows["book_id"].iloc[0], len(out) + 1, at + 1, end, int(total[end] - total[at])))
            at = end
        return pd.DataFrame(out, columns=["book_id", "slice_id", "start_line", "end_line", "char_len"])

    left = sizes(lines).select("book_id", "line_no", "chars").groupBy("book_id")
    return left.cogroup(cuts.select("book_id", "end_line").distinct().groupBy("book_id")).applyInPandas(book, SLICES)


def with_text(slices: DataFrame, lines: DataFrame) -> DataFrame:
    """Slices with their lines joined: each line finds its slice by the last start at or before it."""
    starts = slices.select("book_id", F.col("start_line").alias("line_no"), "slice_id", "end_line", F.lit(None).cast("string").alias("text"))
    marked = starts.unionByName(lines.select("book_id", "line_no", F.lit(None).cast("long").alias("slice_id"), F.lit(None).cast("long").alias("end_line"), "text"))
    so_far = Window.partitionBy("book_id").orderBy("line_no", F.col("slice_id").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = marked.withColumn("slice_id", F.last("slice_id", True).over(so_far)).withColumn("end_line", F.last("end_line", True).over(so_far))
    texts = placed.filter("text is not null and line_no <= end_line").groupBy("book_id", "slice_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), "\n").alias("text"))
    return slices.join(texts, ["book_id", "slice_id"], "left")


def run_summary(slices: DataFrame) -> DataFrame:
    """(book_id, slices_written, lines_covered, chars_written, status): what the run file says of each book."""
    failed = F.max(F.col("char_len").isNull())
    return slices.groupBy("book_id").agg(F.count("*").alias("slices_written"), F.max("end_line").alias("lines_covered"), F.sum("char_len").alias("chars_written"), F.when(failed, F.lit("error")).otherwise(F.lit("ok")).alias("status"))
