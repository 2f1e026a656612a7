"""E-books: EPUB archives as a table of their documents in reading order.

``read_epubs`` lists archives with Spark's binaryFile source and opens each in the task that holds it;
a book is the unit of parallel work.  A faulty archive gives one row with an error where that is asked
for, and fails the job where not.
"""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkmill.functions.markup import html_text
from inkmill.functions.text import normalize, paragraphs
from inkmill.sources.names import book_name, root_of

# The media types of text documents, and where an archive names its package.
TEXT_TYPES = ("application/xhtml+xml", "text/html", "application/html+xml")
CONTAINER = "META-INF/container.xml"
DOCS = "book_id string, spine_pos int, href string, media_type string, content binary, error string"


class EpubError(ValueError):
    """The archive lacks a part that it must have."""


def _xml(archive: zipfile.ZipFile, name: str) -> ElementTree.Element:
    try:
        return ElementTree.fromstring(archive.read(name))
    except KeyError:
        raise EpubError(f"missing in archive: {name}") from None
    except ElementTree.ParseError as e:
        raise EpubError(f"faulty XML in {name}: {e}") from e


def package_path(archive: zipfile.ZipFile) -> str:
    """Path of the package file that the container names first."""
    root = _xml(archive, CONTAINER).find(".//{*}rootfile")
    if root is None or not root.get("full-path"):
        raise EpubError("the container names no package")
    return root.get("full-path")


def spine(archive: zipfile.ZipFile) -> Iterator[tuple[int, str, str]]:
    """(position, path, media type) of the documents in reading order."""
    package = package_path(archive)
    root, folder = _xml(archive, package), posixpath.dirname(package)
    entries = [(e.get("id"), e.get("href"), e.get("media-type") or "") for e in root.findall(".//{*}manifest/{*}item")]
    items = {i: (href, kind) for i, href, kind in entries if i and href}  # the last of equal ids counts
    order = root.find(".//{*}spine")
    if order is None:
        raise EpubError("the package has no spine")
    for number, ref in enumerate(order.findall("{*}itemref")):
        if ref.get("idref") in items:
            href, kind = items[ref.get("idref")]
            yield number, posixpath.normpath(posixpath.join(folder, href)), kind


def documents(data: bytes) -> Iterator[tuple[int, str, str, bytes | None]]:
    """Spine entries with their content, which is null where the archive lacks the member."""
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        names = set(archive.namelist())
        for number, path, kind in spine(archive):
            if kind.lower() in TEXT_TYPES:
                yield number, path, kind, archive.read(path) if path in names else None


def read_epubs(spark: SparkSession, path: str, keep_errors: bool = False) -> DataFrame:
    """DOCS of every .epub under ``path``; members that an archive lacks have null content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.epub").option("recursiveFileLookup", "true").load(path)
    return open_archives(files, root_of(spark, path), keep_errors)


def open_archives(files: DataFrame, root: str, keep_errors: bool = False) -> DataFrame:
    """DOCS of ``files(path, content)``; a book is named by its path below ``root``."""

    def opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["book_id", "spine_pos", "href", "media_type", "content", "error"]
        for batch in batches:
            for name, data in zip(batch["path"], batch["content"], strict=True):
                book = book_name(name, root)
                try:
                    rows = [(book, *d, None) for d in documents(data)]
                except (EpubError, zipfile.BadZipFile) as e:
                    if not keep_errors:
                        raise
                    rows = [(book, None, None, None, None, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(rows, columns=columns)

    return files.select("path", "content").mapInPandas(opened, DOCS)


def book_paragraphs(docs: DataFrame, text_of: Callable[[Column], Column] = html_text) -> DataFrame:
    """(book_id, para_no, text): normalised paragraphs, numbered through the whole book."""
    text = normalize(text_of(F.col("content")))
    each = docs.filter("content is not null").select("book_id", "spine_pos", F.posexplode(paragraphs(text)).alias("pos", "text"))
    order = Window.partitionBy("book_id").orderBy("spine_pos", "pos")
    return each.select("book_id", F.row_number().over(order).cast("long").alias("para_no"), "text")


def read_paragraphs(spark: SparkSession, path: str) -> DataFrame:
    return book_paragraphs(read_epubs(spark, path))
