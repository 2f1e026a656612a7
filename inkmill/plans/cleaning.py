"""From e-books or paragraphs to clean lines and the log of rule hits."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from inkmill.operators import assemble
from inkmill.plans.config import Headings, Rule
from inkmill.sources.epub import read_paragraphs


@dataclass(frozen=True)
class Cleaned:
    """Results of one plan: lines(book_id, line_no, text) and extracted(book_id, para_no, match_no, bucket, rule, text).

    Both are read off ``treated``; inside of ``with cleaned.once()`` that is computed a single time.
    """

    treated: DataFrame

    @property
    def lines(self) -> DataFrame:
        return assemble.lines(self.treated)

    @property
    def extracted(self) -> DataFrame:
        return assemble.extracted(self.treated)

    @contextmanager
    def once(self) -> Iterator[None]:
        self.treated.persist()
        try:
            yield
        finally:
            self.treated.unpersist()


def clean_paragraphs(paragraphs: DataFrame, rules: Sequence[Rule], headings: Headings) -> Cleaned:
    return Cleaned(assemble.treat(assemble.body(paragraphs, headings), rules))


def clean_epubs(spark: SparkSession, path: str, rules: Sequence[Rule], headings: Headings) -> Cleaned:
    return clean_paragraphs(read_paragraphs(spark, path), rules, headings)
