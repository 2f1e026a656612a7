"""Names of books: a file's path below the folder that was read, without its ending.

So two files of one name in different folders are two books, and the same file has the same name in every run.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_SCHEME = r"\A[A-Za-z][A-Za-z0-9+.\-]*:(?://[^/]*)?"
_ENDING = r"(?i)\.(?:epub|txt|text|md)$"


def root_of(spark: SparkSession, path: str) -> str:
    """Path of the folder that ``path`` reads, without scheme; of a pattern, the part before its first sign."""
    fixed = re.split(r"[*?\[{]", path, maxsplit=1)[0]
    if fixed != path:
        fixed = fixed.rpartition("/")[0] or "/"
    found = spark._jvm.org.apache.hadoop.fs.Path(fixed)
    whole = found.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(found).toString()
    return re.sub(_SCHEME, "", whole).rstrip("/")


def book_name(path: str, root: str) -> str:
    """The name of the book in a file; ``path`` may have a scheme."""
    plain = re.sub(_SCHEME, "", path)
    below = plain[len(root) + 1 :] if plain.startswith(root + "/") else plain.rpartition("/")[2]
    return re.sub(_ENDING, "", below)


def book_column(path: Column, root: str, encoded: bool = False) -> Column:
    """``book_name`` of a column; ``encoded`` if it is percent-encoded, as locations in Spark's file metadata are."""
    plain = F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))) if encoded else path, _SCHEME, "")
    below = F.when(F.startswith(plain, F.lit(root + "/")), F.substr(plain, F.lit(len(root) + 2))).otherwise(F.regexp_extract(plain, "[^/]*$", 0))
    return F.regexp_replace(below, _ENDING, "")
