"""Text files as numbered lines, one book a file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions.regexes import NOT_SPACE
from inkmill.functions.text import split_lines
from inkmill.sources.names import book_column, root_of


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(book_id, line_no, text): non-blank lines, numbered from 1 without counting blank ones.

    A book is named by its path below ``path``.  Files are split at every line end that Python knows; one file is one row until then, so a file must fit a task.
    """
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    name = book_column(F.col("_metadata.file_path"), root_of(spark, path), encoded=True)
    each = files.select(name.alias("book_id"), F.posexplode(split_lines(F.col("value"))).alias("n", "text"))
    return each.select("book_id", (F.col("n") + 1).cast("long").alias("line_no"), "text")


def count_non_empty_lines(spark: SparkSession, path: str) -> int:
    """Lines between line feeds that hold more than white space."""
    return spark.read.option("lineSep", "\n").text(path).filter(F.col("value").rlike(NOT_SPACE)).count()
