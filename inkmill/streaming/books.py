"""Books as a stream: new archives in a folder are cleaned as they arrive.

Cleaning keeps no state across books, so every micro-batch runs the batch plan on the files that it
brings, and writes its books to partitions of their own.  A batch that is repeated after a failure
overwrites just those partitions, so results come exactly once; a book that is delivered again and has no
lines, hits or errors any more loses those that it had.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from inkmill.plans.cleaning import clean_paragraphs
from inkmill.plans.config import Headings, Rule
from inkmill.sources.epub import book_paragraphs, open_archives
from inkmill.sources.names import book_column, root_of

FILES = "path string, modificationTime timestamp, length long, content binary"


def clean_stream(spark: SparkSession, folder: str, rules: Sequence[Rule], headings: Headings, out: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Start cleaning ``folder``; lines and rule hits go to ``out``/lines and ``out``/extracted by book."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.epub").load(folder)

    root = root_of(spark, folder)

    def batch(df: DataFrame, _: int) -> None:
        docs = open_archives(df, root, keep_errors=True).persist()
        books = df.select(book_column(F.col("path"), root).alias("book_id")).distinct()
        cleaned = clean_paragraphs(book_paragraphs(docs), rules, headings)
        with cleaned.once():
            for name, table in (("lines", cleaned.lines), ("extracted", cleaned.extracted), ("errors", docs.filter(F.col("error").isNotNull()).select("book_id", "error"))):
                table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("book_id").parquet(f"{out}/{name}")
                _clear(books.join(table.select("book_id").distinct(), "book_id", "left_anti"), f"{out}/{name}")
        docs.unpersist()

    writer = files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _clear(books: DataFrame, table: str) -> None:
    """Remove what an earlier delivery has left of ``books``, one at a time; overwriting touches only books with rows."""
    spark = books.sparkSession
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for r in books.toLocalIterator():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/book_id={escape(r['book_id'])}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
