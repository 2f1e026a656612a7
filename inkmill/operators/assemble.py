"""From paragraphs to clean lines: sentences, rules, stray quotation marks, and lines put together.

Closing quotes at the front of a paragraph belong to the line before, if any line was put out in the book
so far.  That is all a paragraph needs to know of its past, so each one is treated both ways where it
matters, a window finds the first that gives a line, and the rest is a running count of lines and one
aggregation by line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmill.functions import text as T
from inkmill.operators import headings as H
from inkmill.operators.rules import MATCHES, apply_rules, hits, kept
from inkmill.plans.config import Headings, Rule


def _append_last(pieces: Column, more: Column) -> Column:
    return F.concat(F.slice(pieces, 1, F.size(pieces) - 1), F.array(F.concat(F.element_at(pieces, -1), more)))


def glue(pieces: Column) -> Column:
    """(line, tail): pieces with stray quotes put to their neighbours, joined; tail: open quotes that found none."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("held"))

    def add(acc: Column, piece: Column) -> Column:
        # a one-element transform names the joined piece, so that it is written into the plan once
        def placed(x: Column) -> Column:
            grown = F.when(T.only_close_quotes(x) & (F.size(acc["done"]) > 0), _append_last(acc["done"], x)).otherwise(F.concat(acc["done"], F.array(x)))
            opening = T.only_open_quotes(x)
            return F.struct(F.when(opening, acc["done"]).otherwise(grown).alias("done"), F.when(opening, x).otherwise(F.lit("")).alias("held"))

        return F.element_at(F.transform(F.array(F.concat(acc["held"], piece)), placed), 1)

    def finish(acc: Column) -> Column:
        none = F.size(acc["done"]) == 0
        whole = F.when(none | (acc["held"] == ""), acc["done"]).otherwise(_append_last(acc["done"], acc["held"]))
        return F.struct(T.strip(T.join_pieces(whole)).alias("line"), F.when(none, acc["held"]).otherwise(F.lit("")).alias("tail"))

    return F.aggregate(pieces, start, add, finish)


def _treated(text: Column, rules: Sequence[Rule]) -> Column:
    results = F.transform(F.array(text), lambda t: apply_rules(T.sentences(t), rules))
    parts = F.transform(results, lambda r: F.struct(glue(kept(r)).alias("glued"), hits(r).alias("matches")))
    return F.element_at(parts, 1)


def body(paragraphs: DataFrame, headings: Headings) -> DataFrame:
    """The paragraphs (book_id, para_no, text) that stand under strict headings, without leading titles."""
    found = H.skip_titles(H.include(paragraphs, headings), headings)
    return found.filter("included and not skipped").select("book_id", "para_no", "text")


def treat(paragraphs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(book_id, para_no, line, lead, tail, matches) of every paragraph of the body, each in the variant that holds."""
    lead = F.regexp_extract(T.strip_left(F.col("text")), f"\\A[{T.CLOSE_QUOTES}]+", 0)
    rest = T.strip_left(F.substr(T.strip_left(F.col("text")), F.length("lead") + 1))
    # a large book's paragraphs are dealt to all tasks, since windows have brought them together
    dealt = paragraphs.repartition("book_id", "para_no")
    both = dealt.withColumn("lead", lead).withColumn("a", _treated(F.col("text"), rules)).withColumn("b", F.when(F.col("lead") != "", _treated(rest, rules)).otherwise(F.col("a")))
    first = F.min(F.when(F.col("a.glued.line") != "", F.col("para_no"))).over(Window.partitionBy("book_id"))
    later = both.withColumn("later", F.coalesce(F.col("para_no") > first, F.lit(False)))
    chosen = later.withColumn("one", F.when(F.col("later"), F.col("b")).otherwise(F.col("a")))
    return chosen.select("book_id", "para_no", F.col("one.glued.line").alias("line"), F.when(F.col("later"), F.col("lead")).otherwise(F.lit("")).alias("lead"), F.col("one.glued.tail").alias("tail"), F.col("one.matches").alias("matches"))


def lines(treated: DataFrame) -> DataFrame:
    """(book_id, line_no, text): the clean lines, numbered from 1."""
    so_far = Window.partitionBy("book_id").orderBy("para_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    emits = (F.col("line") != "").cast("long")
    numbered = treated.withColumn("line_no", F.sum(emits).over(so_far))
    part = lambda no, kind, text: F.struct(no.alias("line_no"), F.col("para_no"), F.lit(kind).alias("kind"), F.col(text).alias("text"))
    parts = F.array(part(F.col("line_no") - emits, 0, "lead"), part(F.col("line_no"), 1, "line"), part(F.col("line_no"), 2, "tail"))
    each = numbered.select("book_id", F.explode(F.filter(parts, lambda x: (x["text"] != "") & (x["line_no"] > 0))).alias("p")).select("book_id", "p.*")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("para_no", "kind", "text"))), lambda x: x["text"]), "")
    return each.groupBy("book_id", "line_no").agg(whole.alias("text"))


def extracted(treated: DataFrame) -> DataFrame:
    """(book_id, para_no, match_no, bucket, rule, text): the log of rule hits."""
    return treated.select("book_id", "para_no", F.posexplode("matches").alias("match_no", "m")).select("book_id", "para_no", "match_no", "m.bucket", "m.rule", "m.text")


__all__ = ["MATCHES", "body", "extracted", "glue", "lines", "treat"]
